"""DuckDB SQL for the operators that SQL can express.

Hashes, learnt weights, graph components, Newton steps and tokenizers are beyond it; the queries
that need them are tested against plain Python instead.
"""


def centroid_rounds(rounds: int = 10, clusters: int = 8, size: int = 64) -> str:
    """Quantised vectors as (vec_id, d, x); each round's nearest centroids and their new means."""
    sql = f"""
        with kept as materialized (
          select vec_id, embedding from embeddings
          where len(embedding) = {size}
            and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = {size}),
        points as materialized (
          select vec_id, generate_subscripts(embedding, 1) as d,
            cast(floor(1024 * cast(unnest(embedding) as double)) as bigint) as x
          from kept),
        first as (
          select vec_id, row_number() over (order by sha256('3:' || vec_id)) - 1 as c from kept
          qualify c < {clusters}),
        c0 as materialized (select c, d, x from first join points using (vec_id))"""
    for r in range(rounds + 1):
        sql += f""",
        n{r} as materialized (
          select vec_id, min(distance) as distance, arg_min(c, (distance, c)) as c
          from (select vec_id, c.c, cast(sum((p.x - c.x) * (p.x - c.x)) as bigint) as distance
                from points p join c{r} c using (d) group by vec_id, c.c)
          group by vec_id)"""
        if r < rounds:
            # The remainder is made positive, so that the division is exact.
            sql += f""",
        m{r} as (
          select c, d, cast(sum(x) as bigint) as s, count(*) as n
          from points join n{r} using (vec_id) group by c, d),
        c{r + 1} as materialized (
          select c, d, coalesce(cast((s - ((s % n) + n) % n) // n as bigint), old.x) as x
          from c{r} old left join m{r} using (c, d))"""
    return sql + f""",
        digests as (
          select c, sha256(string_agg(cast(x as varchar), ',' order by d)) as centroid_sha256
          from c{rounds} group by c)
        select vec_id, cast(c as integer) as cluster, distance,
          cast(sum(distance) over (partition by c) as bigint) as cluster_inertia,
          cast(sum(distance) over () as bigint) as inertia, centroid_sha256
        from n{rounds} join digests using (c)"""


ORACLE: dict[str, str] = {
    "op5_exact_dedup": r"""
        with squeezed as (
          select doc_id, length(coalesce(text, '')) as n_chars,
            regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') as body
          from documents),
        grouped as (
          select doc_id, body, count(*) over (partition by body) as group_size,
            first_value(doc_id) over (partition by body order by n_chars desc, doc_id) as keep_id
          from squeezed)
        select doc_id, keep_id, group_size, doc_id = keep_id as kept, sha256(body) as text_sha256
        from grouped""",
    "op11_centroids": centroid_rounds(),
    "op12_filter_audit": r"""
        with texts as (
          select doc_id, coalesce(lang, '') as part, coalesce(text, '') as text from documents),
        measured as (
          select *, list_filter(
            regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') as words,
            min(doc_id) over (partition by text) as least
          from texts),
        marks as (
          select doc_id, max(case when quality = 1 then 1 else 0 end) as good,
            max(case when toxic = 1 then 1 else 0 end) as toxic
          from labels group by doc_id),
        judged as (
          select part, coalesce(good, 0) as good, coalesce(toxic, 0) as toxic, map {
            'A': len(words) < 100,
            'B': 100 * len(list_distinct(words)) < 80 * len(words),
            'C': 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text),
            'D': regexp_matches(text, '[#$%&*|]'),
            'E': coalesce(least < doc_id, least is not null)} as fails
          from measured left join marks using (doc_id)),
        combos as (select part, fails, count(*) as n, sum(good) as good, sum(toxic) as toxic
          from judged group by part, fails),
        letters as (select unnest(['A', 'B', 'C', 'D', 'E']) as f),
        orders as (
          select a.f || b.f || c.f || d.f || e.f as filter_order
          from letters a, letters b, letters c, letters d, letters e
          where len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5),
        steps as (select filter_order, unnest(range(1, 6)) as step from orders),
        hits as (
          select part, filter_order, step, n, good, toxic,
            fails[filter_order[step]] as fails_now,
            len(list_filter(['A', 'B', 'C', 'D', 'E'], lambda x: fails[x])) = 1 as one_only,
            len(list_filter(string_split(filter_order[1:step - 1], ''), lambda x: x <> '' and fails[x])) > 0
              as gone
          from steps cross join combos),
        counted as (
          select part, filter_order, step,
            sum(case when not gone and not fails_now then n else 0 end) as kept,
            sum(case when not gone and fails_now then n else 0 end) as removed,
            sum(case when gone and fails_now then n else 0 end) as redundant,
            sum(case when one_only and fails_now then n else 0 end) as unique_fails,
            sum(case when not gone and fails_now then good else 0 end) as good_lost,
            sum(case when not gone and fails_now then toxic else 0 end) as toxic_lost
          from hits group by part, filter_order, step)
        select part, filter_order, cast(step as integer) as step, cast(kept as bigint) as kept,
          cast(removed as bigint) as removed, cast(redundant as bigint) as redundant,
          cast(unique_fails as bigint) as unique_fails, cast(good_lost as bigint) as good_lost,
          cast(toxic_lost as bigint) as toxic_lost,
          cast(sum(removed) over (partition by part, filter_order[step]) as bigint) as shapley
        from counted""",
}
