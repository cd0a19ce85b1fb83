"""Bars for the tests."""

from __future__ import annotations


def bar(day, o, h, l, c, volume=1000, symbol="RELIANCE", seq=0, asset_type="EQUITY"):
    key = symbol.replace(" ", "_").replace("/", "_").replace("^", "").replace("=", "_")
    return (day, o, h, l, c, c, volume, 0.0, 0.0, symbol, asset_type, key, seq)
