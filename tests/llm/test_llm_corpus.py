"""Mixing, packing, chat formatting, token counts and the pipeline."""

from __future__ import annotations

import heapq
import math
import random
import re
import tempfile
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F

import corpus_pipeline
from barloom.llm import chat_format as chat
from barloom.llm import entropy_mixing as mixing
from barloom.llm import length_packing as packing
from barloom.llm import token_scan
from test_llm_dedup import squeezed

SF = "/root/testdata/sf0.001"


def n_words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def plain_targets(sizes):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode())
    names += [None] if None in sizes else []
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    total, target, capped = 1.5 * sum(sizes.values()), {}, set()
    while True:
        rest = [s for s in names if s not in capped]
        left = total - sum(2 * sizes[s] for s in capped)
        target = {s: left * weight[s] / sum(weight[x] for x in rest) for s in rest}
        over = {s for s in rest if target[s] > 2 * sizes[s]}
        if not over:
            return {**target, **{s: 2 * sizes[s] for s in capped}}
        capped |= over


def check_mix(rows, docs):
    sizes = Counter()
    for _, text, source in docs:
        sizes[source] += n_words(text)
    target = plain_targets(sizes)
    taken, largest = Counter(), Counter()
    assert len(rows) == len(docs)
    assert Counter((r["doc_id"], r["size"]) for r in rows) == Counter(
        (i, n_words(t)) for i, t, _ in docs)
    for r in rows:
        assert r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(target[r["source"]])
        assert 0 <= r["taken"] <= 2 * r["size"] and r["taken"] == r["copies"] * r["size"]
        taken[r["source"]] += r["taken"]
        largest[r["source"]] = max(largest[r["source"]], r["size"])
    for s in sizes:
        assert abs(taken[s] - target[s]) <= 1.5 * largest[s] + 1, s
    return target


def test_mix_of_odd_rows(odd, odd_rows):
    rows = mixing.mix(odd).collect()
    check_mix(rows, [(r[0], r[1], r[3]) for r in odd_rows])


def test_mix_of_documents(real):
    docs = real("documents")
    rows = mixing.mix(docs).collect()
    check_mix(rows, [tuple(r) for r in docs.select("doc_id", "text", "source").collect()])
    assert sorted(mixing.mix(docs.repartition(3)).collect(), key=str) == sorted(rows, key=str)


def test_rates_are_exponential_in_the_size(real):
    """The optimality condition of the dual: log rates are linear in the size, up to the cap."""
    by_source = defaultdict(list)
    for r in mixing.mix(real("documents")).collect():
        if r["rate"] < 2 and r["size"]:
            by_source[r["source"]].append(math.log(r["rate"]) / r["size"])
    assert by_source
    for tilts in by_source.values():
        assert np.ptp(tilts) <= 1e-9 + 1e-6 * abs(tilts[0])


def test_expected_words_meet_the_targets(real):
    words, target = Counter(), {}
    for r in mixing.mix(real("documents")).collect():
        words[r["source"]] += r["rate"] * r["size"]
        target[r["source"]] = r["target"]
    for s, t in target.items():
        assert words[s] == pytest.approx(t, rel=1e-5)


def test_mix_edge_cases(none, odd, spark):
    assert mixing.mix(none).count() == 0 and mixing.take_copies(none).count() == 0
    empty = odd.where("text is null or text = ''")
    assert {r["taken"] for r in mixing.mix(empty).collect()} == {0}
    one = spark.createDataFrame([(i, "w " * 10, "s") for i in range(9)], "doc_id long, text string, source string")
    assert sum(r["taken"] for r in mixing.mix(one).collect()) in (130, 140)


def test_take_copies(odd, odd_rows):
    left = mixing.take_copies(odd)
    assert left.columns == odd.columns
    copies = Counter((r["doc_id"], r["text"]) for r in left.collect())
    given = Counter((r[0], r[1]) for r in odd_rows)
    assert all(copies[k] <= 2 * n for k, n in given.items()) and set(copies) <= set(given)
    assert copies[2, None] == 1


def words_taken(rows, count):
    taken = Counter()
    for r in rows:
        taken[r["source"]] += count(r)
    return +taken


@pytest.mark.parametrize("rate", [0.1, 0.5, 1.2])
def test_take_copies_tells_rows_of_one_key_apart(spark, rate):
    """Rows with a null id or a repeated one and texts of equal size, a third of each source."""
    rows = [(None, f"null {i} a b", "s1") for i in range(300)]
    rows += [(7, f"seven {i} c", "s2") for i in range(300)]
    rows += [(1000 + i, "w " * (1 + i % 9), f"s{1 + i % 2}") for i in range(600)]
    rows += [(5000, "one text", "s1")] * 50
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    settings = mixing.Settings(weights=(1.0,), share=rate)
    left = mixing.take_copies(docs, settings)
    dealt = mixing.mix(docs, settings).collect()
    assert left.columns == docs.columns
    left = left.collect()
    assert words_taken(left, lambda r: n_words(r["text"])) == words_taken(
        dealt, lambda r: r["taken"])
    by_key, given = Counter(), Counter()
    for r in dealt:
        by_key[r["doc_id"], r["source"], r["size"]] += r["copies"]
    given.update(rows)
    assert Counter((r["doc_id"], r["source"], n_words(r["text"])) for r in left) == +by_key
    assert all(n <= 2 * given[tuple(r)] for r, n in Counter(left).items())
    again = mixing.take_copies(docs.repartition(3), settings).collect()
    assert Counter(again) == Counter(left)


def test_mix_runs_no_python(real):
    plan = mixing.mix(real("documents"))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def padding(histogram, bounds):
    return sum(n * (min(b for b in bounds if b >= k) - k) for k, n in histogram.items())


@pytest.mark.parametrize("seed", range(6))
def test_boundaries_are_optimal(seed):
    from itertools import combinations

    rng = random.Random(seed)
    histogram = {rng.randrange(1, 60): rng.randrange(1, 9) for _ in range(rng.randrange(1, 10))}
    for k in range(1, 5):
        found = packing.boundaries(histogram, k)
        assert len(found) <= k and found[-1] == max(histogram) and found == sorted(set(found))
        best = min(
            padding(histogram, [*some, max(histogram)])
            for m in range(min(k, len(histogram)))
            for some in combinations(sorted(histogram)[:-1], m))
        assert padding(histogram, found) == best
    assert packing.boundaries({}, 3) == []


def check_packing(rows, docs, settings):
    given = Counter()
    for i, text in docs:
        n = n_words(text)
        for p in range(max(1, -(-n // settings.max_tokens))):
            start = p * settings.max_tokens
            given[i, p, start, min(settings.max_tokens, n - start)] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["n_tokens"]) for r in rows) == given
    histogram = Counter(r["n_tokens"] for r in rows if r["n_tokens"])
    bounds = packing.boundaries(histogram, settings.buckets)
    batches = defaultdict(list)
    for r in rows:
        if not r["n_tokens"]:
            assert (r["bucket"], r["padded_to"], r["batch"], r["slot"]) == (None,) * 4
            continue
        assert r["padded_to"] == bounds[r["bucket"]] == min(b for b in bounds if b >= r["n_tokens"])
        batches[r["bucket"], r["batch"]].append(r["slot"])
    for (bucket, batch), slots in batches.items():
        room = max(1, settings.batch_tokens // bounds[bucket])
        assert sorted(slots) == list(range(len(slots))) and len(slots) <= room
        assert len(slots) == room or (bucket, batch + 1) not in batches


@pytest.mark.parametrize("settings", [packing.SETTINGS, packing.Settings(64, 3, 200)])
def test_packing(odd, odd_rows, real, settings):
    check_packing(packing.packed(odd, settings).collect(), [r[:2] for r in odd_rows], settings)
    docs = real("documents")
    check_packing(packing.packed(docs, settings).collect(),
                  [tuple(r) for r in docs.select("doc_id", "text").collect()], settings)


def test_packing_of_nothing(none, odd):
    assert packing.packed(none).count() == 0
    assert packing.packed(odd.where("text is null")).where("batch is not null").count() == 0


def cheapest(roles, settings=chat.SETTINGS):
    """Dijkstra over (turns read, state): insert, open as any legal role, or merge."""
    seen, queue = set(), [(0, 0, 0)]
    while queue:
        cost, i, s = heapq.heappop(queue)
        if (i, s) in seen:
            continue
        seen.add((i, s))
        if i == len(roles) and s == chat.END:
            return cost
        for a, b in chat.LEGAL:
            if a == s:
                heapq.heappush(queue, (cost + settings.insert, i, b))
                if i < len(roles):
                    heapq.heappush(queue, (cost + settings.relabel * (roles[i] != b), i + 1, b))
        if i < len(roles) and s:
            heapq.heappush(
                queue, (cost + settings.merge + settings.relabel * (roles[i] != s), i + 1, s))
    raise AssertionError


def check_chats(rows, given):
    """`given`: conv -> (turn, role, text) tuples in order."""
    by_conv = defaultdict(list)
    for r in rows:
        by_conv[r["conv_id"]].append(r)
    assert set(by_conv) == set(given)
    for conv, turns in given.items():
        own = sorted(by_conv[conv], key=lambda r: r["position"])
        assert [r["position"] for r in own] == list(range(len(turns)))
        assert [(r["turn"], r["role"]) for r in own] == [t[:2] for t in turns]
        wanted = cheapest([chat.role_number(t[1]) for t in turns])
        assert {r["cost"] for r in own} == {wanted}
        # The rendered text parses into a legal sequence that holds all texts in order.
        text = "".join(r["piece"] for r in own)
        parsed = re.findall(r"<\|im_start\|>(\w+)\n(.*?)<\|im_end\|>\n", text, re.S)
        assert "".join(f"<|im_start|>{r}\n{t}<|im_end|>\n" for r, t in parsed) == text
        states = [0, *(chat.ROLES.index(r) for r, _ in parsed)]
        assert all(step in chat.LEGAL for step in zip(states, states[1:])) and states[-1] == chat.END
        spent = sum(chat.SETTINGS.insert * r["inserted"] + chat.SETTINGS.merge * r["action"].startswith("merge")
                    + chat.SETTINGS.relabel * r["action"].endswith("relabel") for r in own)
        assert spent == wanted
        assert [x for _, t in parsed for x in t.split("\n") if x] == [
            x for t in turns for x in (t[2] or "").split("\n") if x]


def ordered(rows):
    out = defaultdict(list)
    for conv, turn, role, text in sorted(
            rows, key=lambda r: (str(r[0]), -1 if r[1] is None else r[1], r[2] or "")):
        out[conv].append((turn, role, text))
    return out


ROLE_POOL = ["user", "assistant", "system", "User ", "bot", None, "tool", "human"]


def random_chats(seed, convs=40, hot=0):
    rng = random.Random(seed)
    rows = []
    for c in range(convs):
        n = hot if hot and c == 3 else rng.randrange(1, 9)
        rows += [(c, t, rng.choice(ROLE_POOL), f"t{c}.{t}" if rng.random() < 0.9 else None)
                 for t in range(n)]
    return rows


@pytest.mark.parametrize("seed,hot", [(1, 0), (2, 0), (3, 700)])
def test_random_chats(spark, seed, hot):
    """With a hot conversation that lies in several partitions."""
    rows = random_chats(seed, hot=hot)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    check_chats(chat.format_chats(df.repartition(4)).collect(), ordered(rows))


def test_given_conversations(real):
    df = real("conversations")
    rows = [tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()]
    check_chats(chat.format_chats(df).collect(), ordered(rows))


def test_chat_edge_cases(spark):
    schema = "conv_id long, turn long, role string, text string, cost int, piece string"
    rows = [(None, None, None, None), (None, 0, "user", "hi"), (1, 0, "assistant", "a"),
            (2, 0, "system", "s"), (3, 0, "user", "x"), (3, 0, "user", "x"), (4, 5, "user", "")]
    df = spark.createDataFrame([(*r, 1, "old") for r in rows], schema)
    check_chats(chat.format_chats(df).collect(), ordered(rows))
    assert chat.format_chats(df.limit(0)).count() == 0


def test_spans_and_repairs_agree():
    automaton = chat.Automaton(chat.SETTINGS)
    rng = np.random.default_rng(1)
    for n in (1, 2, 3, 17):
        roles = rng.integers(0, 4, n)
        cost = int((automaton.span(roles)[0] + automaton.end).min())
        before, after = automaton.repair(roles, np.array([0, n]), np.array([0]), np.array([-1]))
        assert before[0] == 0 and (before[1:] == after[:-1]).all()
        assert automaton.cost[roles, before, after].sum() + automaton.end[after[-1]] == cost
        assert cost == cheapest(list(roles))


def plain_counts(tokens, end):
    out, start = [], 0
    for i, t in enumerate(tokens):
        if t == end:
            out.append((len(out), start, i - start, True))
            start = i + 1
    return out + ([(len(out), start, len(tokens) - start, False)] if start < len(tokens) else [])


@pytest.mark.parametrize("block", [1, 2, 3, 7, 1000])
def test_scan_of_any_blocks(spark, tmp_path, block):
    rng = np.random.default_rng(block)
    files = {
        "part-0": rng.integers(0, 6, 200), "part-1": [], "part-2": [2, 2, 2], "part-3": [5] * 50,
        "part-4": [5] * 20 + [2] + [7] * 20, "tokens.bin": [2], "another": [5, 2, 5],
    }
    for name, tokens in files.items():
        (tmp_path / name).write_bytes(np.array(tokens, "<u2").tobytes())
    (tmp_path / "part-6").write_bytes(b"\x05\x00\x02\x00\x07")
    files["part-6"] = [5, 2]
    (tmp_path / "_log").write_bytes(b"\x05\x00")
    scanned = token_scan.separators(spark, str(tmp_path), 2, block)
    found = defaultdict(list)
    for r in token_scan.count_tokens(scanned, block).collect():
        found[r["file"].rsplit("/", 1)[1]].append((r["doc"], r["start"], r["n_tokens"], r["closed"]))
    for name, tokens in files.items():
        assert sorted(found[name]) == plain_counts(list(tokens), 2), name
    assert "_log" not in found


def test_files_that_no_task_can_hold_are_an_error(spark, tmp_path, monkeypatch):
    (tmp_path / "part-0").write_bytes(b"\x05\x00" * 10)
    monkeypatch.setattr(token_scan, "FILE_BYTES", 19)
    with pytest.raises(ValueError, match="part-0 has 20 bytes"):
        token_scan.separators(spark, str(tmp_path))


def test_counts_are_the_tokenizers(spark, odd, odd_rows, real, tmp_path):
    model = sentencepiece.SentencePieceProcessor(model_file=token_scan.TOKENIZER)
    odd.write.parquet(str(tmp_path / "odd"))
    for name, docs in (("a", spark.read.parquet(str(tmp_path / "odd"))), ("b", real("documents"))):
        found = token_scan.token_counts(docs, tempfile.mkdtemp() + "/" + name).collect()
        wanted = Counter(
            (r["doc_id"], len(model.encode(r["text"] or ""))) for r in docs.collect())
        assert Counter((r["doc_id"], r["n_tokens"]) for r in found) == wanted
        assert all(r["closed"] for r in found)


def test_places_are_read_off_the_end_of_the_name(spark):
    """A uuid can have a part that looks like a file number."""
    names = ["file:/x/part-7-y/part-00012-0b1f3c5e-c412-4e0a-c98b-c12345678901-c003.txt",
             "hdfs://h/flat/part-00000-aaaaaaaa-c000-4bbb-c111-cccccccccccc-c000.txt"]
    df = spark.createDataFrame([(n, 5) for n in names], "file string, doc long")
    found = [tuple(r) for r in df.select(*token_scan.places_of("file").values()).collect()]
    assert found == [(12, 3 * token_scan.FILE_DOCS + 5), (0, 5)]


def test_flat_files_hold_the_ids(spark, real, tmp_path):
    model = sentencepiece.SentencePieceProcessor(model_file=token_scan.TOKENIZER)
    docs = real("documents").limit(20).coalesce(1)
    token_scan.write_flat(docs, str(tmp_path / "flat"))
    files = sorted(p for p in (tmp_path / "flat").iterdir() if p.name.startswith("part-"))
    ids = np.concatenate([np.frombuffer(p.read_bytes(), "<u2") for p in files]).tolist()
    assert ids == [i for r in docs.collect() for i in [*model.encode(r["text"] or ""), 2]]


def test_splits_dont_follow_the_cores(spark, real, tmp_path, monkeypatch):
    """Executors that are lost between the two reads change nothing in how files are split."""
    docs, name = real("documents"), "spark.sql.files.minPartitionNum"
    seen = []
    write = token_scan.write_flat
    monkeypatch.setattr(
        token_scan, "write_flat", lambda *a: (seen.append(spark.conf.get(name)), write(*a)))
    n = token_scan.token_counts(docs, str(tmp_path / "flat")).count()
    assert n == docs.count() and seen == [str(spark.sparkContext.defaultParallelism)]
    assert spark.conf.get(name, None) is None


def test_counts_of_nothing(none, tmp_path, spark):
    none.write.parquet(str(tmp_path / "none"))
    docs = spark.read.parquet(str(tmp_path / "none"))
    assert token_scan.token_counts(docs, str(tmp_path / "flat")).count() == 0


def test_stages_of_the_pipeline(spark, real):
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "exact dedup", "simhash near-dedup",
        "mixing sources to target weights", "packing"]
    docs, labels = real("documents"), {r["doc_id"]: r["quality"] for r in real("labels").collect()}
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs.count()
        out = stage(spark, docs, SF)
        assert out.columns == columns, name
        folder = tempfile.mkdtemp() + "/out"
        out.write.parquet(folder)
        docs = spark.read.parquet(folder)
        rows = docs.collect()
        if name == "quality classifier":
            kept = {r["doc_id"] for r in rows}
            assert np.mean([i in kept for i, q in labels.items() if q == 1]) > 0.9
            assert np.mean([i in kept for i, q in labels.items() if q == 0]) < 0.4
        elif name == "exact dedup":
            assert len({squeezed(r["text"]) for r in rows}) == len(rows) < before
        elif name.startswith("simhash"):
            assert len(rows) < before
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() >= docs.count()


def test_pipeline_as_a_whole(spark):
    out = corpus_pipeline.run(spark, SF)
    assert {"doc_id", "bucket", "batch", "slot"} <= set(out.columns) and out.count() > 50
    full = out.where("n_tokens > 0").groupBy("bucket", "batch").agg(
        F.count("*").alias("n"), F.max("padded_to").alias("p"))
    assert full.where("n * p > 16384 and n > 1").count() == 0
