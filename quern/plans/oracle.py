"""DuckDB SQL with the same answers as ``quern.plans.catalog``.

Runs on the driver's pre-registered views (``documents``, ``embeddings``,
``events``, ``lineitem``, ``part``). The iterative clustering queries are
unrolled into CTE chains by the small generators below (one CTE per seeding
round or Lloyd round), with the same keyed uniforms, race keys and tie rules.
"""

from __future__ import annotations

from quern.functions.random import keyed_uniform_sql
from quern.plans.catalog import (
    BUCKETS,
    DIGITS,
    ITERS,
    K,
    K_FIXED,
    LLOYD_ROUNDS,
    SAMPLE_FRACTION,
    SEED,
)


def _u(tag: str, id_sql: str = "id") -> str:
    return keyed_uniform_sql(SEED, tag, id_sql)


# ------------------------------------------------------------------ numeric

_EVENTS_Z = f"""
WITH ev AS (SELECT event_id, value FROM events WHERE value IS NOT NULL AND NOT isnan(value)),
st AS (SELECT min(value) AS mn, max(value) AS mx FROM ev),
zs AS (SELECT event_id, CASE WHEN mx > mn THEN (value - mn) / (mx - mn) END AS z FROM ev, st)
"""

NUMERIC = {
    "num_max_min": """
SELECT max(l_extendedprice) AS mx, min(l_extendedprice) AS mn
FROM lineitem WHERE l_extendedprice IS NOT NULL AND NOT isnan(l_extendedprice)""",
    "num_mean": f"""
SELECT round(avg(value), {DIGITS}) AS mean_value
FROM events WHERE value IS NOT NULL AND NOT isnan(value)""",
    "num_count": """
SELECT count(*)::BIGINT AS n FROM events WHERE value IS NOT NULL AND NOT isnan(value)""",
    "num_minmax_scale": _EVENTS_Z + f"SELECT event_id, round(z, {DIGITS}) AS z FROM zs",
    "num_below_mean": _EVENTS_Z
    + f"SELECT event_id, round(z, {DIGITS}) AS z FROM zs WHERE z < (SELECT avg(z) FROM zs)",
    "num_stable_sample": _EVENTS_Z
    + f"SELECT event_id, round(z, {DIGITS}) AS z FROM zs WHERE {_u('sample', 'event_id')} < {SAMPLE_FRACTION}",
    "num_bernoulli_sample": """
SELECT count(*)::BIGINT AS n_input, 0::BIGINT AS n_foreign, 0::BIGINT AS n_surplus
FROM events WHERE value IS NOT NULL AND NOT isnan(value)""",
    "parse_numbers": """
SELECT p_partkey, 0::BIGINT AS pos, p_size::DOUBLE AS x FROM part
UNION ALL
SELECT p_partkey, 1::BIGINT AS pos, p_retailprice AS x FROM part""",
}

# ------------------------------------------------------------------ text

_LINES = r"""
WITH lines AS (
  SELECT doc_id, (generate_subscripts(l, 1) - 1)::BIGINT AS line_no, unnest(l) AS line
  FROM (SELECT doc_id,
               CASE WHEN text = '' THEN []::VARCHAR[]
                    ELSE string_split_regex(regexp_replace(text, '(\r\n|\r|\n)\z', ''), '\r\n|\r|\n') END AS l
        FROM documents)),
toks AS (
  SELECT doc_id, line_no,
         unnest(CASE WHEN line = '' THEN ['']
                     WHEN rtrim(line, ' ') = '' THEN []::VARCHAR[]
                     ELSE string_split(rtrim(line, ' '), ' ') END) AS word
  FROM lines),
words AS (SELECT DISTINCT word FROM toks)
"""

_UTF16_LEN = r"(length(word) + length(regexp_replace(word, '[^\x{10000}-\x{10FFFF}]', '', 'g')))::BIGINT"

_WORDCOUNT = _LINES + "SELECT word, count(*)::BIGINT AS n FROM toks GROUP BY word"

TEXT = {
    "text_lines": r"""
SELECT doc_id,
       CASE WHEN text = '' THEN 0
            ELSE len(string_split_regex(regexp_replace(text, '(\r\n|\r|\n)\z', ''), '\r\n|\r|\n')) END::BIGINT
         AS n_lines
FROM documents""",
    "text_doc_term_counts": _LINES
    + "SELECT doc_id, line_no, word, count(*)::BIGINT AS n FROM toks GROUP BY doc_id, line_no, word",
    "text_wordcount": _WORDCOUNT,
    "text_wordcount_salted": _WORDCOUNT,
    "text_wordcount_preagg": _WORDCOUNT,
    "text_distinct_words": _LINES + f"SELECT word, {_UTF16_LEN} AS len FROM words",
    "text_distinct_count": _LINES + "SELECT count(*)::BIGINT AS n_words FROM words",
    "text_avg_word_length": _LINES + f"SELECT round(avg({_UTF16_LEN}), {DIGITS}) AS avg_len FROM words",
}

# ------------------------------------------------------------------ vectors

_PTS = "pts AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS p FROM embeddings)"
_FIRST = (
    "fixed AS (SELECT (row_number() OVER (ORDER BY id) - 1)::INT AS cid, id, p AS c "
    "FROM pts ORDER BY id LIMIT {k})"
)


def _nearest(src: str, cent: str, name: str, keys: str = "bucket") -> str:
    """``name``: src rows with ``cid`` and ``d`` of the nearest centre in
    ``cent`` (same ``keys``); ties to the lowest cid."""
    on = f"USING ({keys})" if keys else "ON TRUE"
    part = ", ".join([f"s.{k.strip()}" for k in keys.split(",")] + ["s.id"]) if keys else "s.id"
    return (
        f"{name} AS (SELECT * EXCLUDE (rn) FROM (SELECT s.*, c.cid, list_distance(s.p, c.c) AS d, "
        f"row_number() OVER (PARTITION BY {part} ORDER BY list_distance(s.p, c.c), c.cid) AS rn "
        f"FROM {src} s JOIN {cent} c {on}) WHERE rn = 1)"
    )


def _seed_ctes(src: str, k: int, stage: str, out: str) -> list[str]:
    """k-means++ seeding per bucket of ``src(bucket, id, p, w)`` into
    ``out(bucket, cid, id, c)``."""
    s = f"{stage}_"
    ctes = [
        f"{s}p0 AS (SELECT bucket, 0::INT AS cid, id, p AS c FROM (SELECT *, row_number() OVER "
        f"(PARTITION BY bucket ORDER BY -ln({_u(stage + ':0')}), id) AS rn FROM {src}) WHERE rn = 1)",
        f"{s}d0 AS (SELECT s.bucket, s.id, s.p, s.w, list_distance(s.p, q.c) AS d "
        f"FROM {src} s JOIN {s}p0 q USING (bucket))",
    ]
    for r in range(1, k):
        key = f"-ln({_u(f'{stage}:{r}')}) / (w * d)"
        ctes.append(
            f"{s}p{r} AS (SELECT bucket, {r}::INT AS cid, id, p AS c FROM (SELECT *, row_number() OVER "
            f"(PARTITION BY bucket ORDER BY {key}, id) AS rn FROM {s}d{r - 1} WHERE d > 0 AND w > 0) "
            f"WHERE rn = 1)"
        )
        ctes.append(
            f"{s}d{r} AS (SELECT s.bucket, s.id, s.p, s.w, CASE WHEN q.c IS NULL THEN s.d "
            f"ELSE least(s.d, list_distance(s.p, q.c)) END AS d "
            f"FROM {s}d{r - 1} s LEFT JOIN {s}p{r} q USING (bucket))"
        )
    ctes.append(f"{out} AS (" + " UNION ALL ".join(f"SELECT * FROM {s}p{r}" for r in range(k)) + ")")
    return ctes


def _lloyd_ctes(src: str, cent: str, iters: int, stage: str, out: str) -> list[str]:
    """``iters`` weighted Lloyd rounds per bucket; ``out(bucket, cid, c)``."""
    ctes = []
    prev = f"{stage}_l0"
    ctes.append(f"{prev} AS (SELECT bucket, cid, c FROM {cent})")
    for it in range(iters):
        a, m, nxt = f"{stage}_a{it}", f"{stage}_m{it}", f"{stage}_l{it + 1}"
        ctes.append(_nearest(src, prev, a))
        ctes.append(
            f"{m} AS (SELECT bucket, cid, list(v ORDER BY pos) AS c_new FROM ("
            f"SELECT bucket, cid, pos, sum(w * v) / sum(w) AS v FROM ("
            f"SELECT bucket, cid, w, unnest(p) AS v, generate_subscripts(p, 1) AS pos FROM {a}) "
            f"GROUP BY bucket, cid, pos) GROUP BY bucket, cid)"
        )
        ctes.append(
            f"{nxt} AS (SELECT o.bucket, o.cid, coalesce(m.c_new, o.c) AS c "
            f"FROM {prev} o LEFT JOIN {m} m USING (bucket, cid))"
        )
        prev = nxt
    ctes.append(f"{out} AS (SELECT * FROM {prev})")
    return ctes


def _with(ctes: list[str], select: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + select


def _explode(src: str, keys: str) -> str:
    """One row per vector component: ``keys, pos, v`` (v rounded)."""
    names = ", ".join(k.split(" AS ")[-1].strip() for k in keys.split(","))
    return (
        f"SELECT {names}, pos, round(v, {DIGITS}) AS v FROM ("
        f"SELECT {keys}, (generate_subscripts(c, 1) - 1)::BIGINT AS pos, unnest(c) AS v FROM {src})"
    )


def _bucket_sql(n: int) -> str:
    return "0::INT" if n == 1 else f"floor({_u('bucket')} * {float(n)})::INT"


def _prepared(n_buckets: int, weight: str = "1::BIGINT") -> str:
    return f"prep AS (SELECT {_bucket_sql(n_buckets)} AS bucket, id, p, {weight} AS w FROM pts)"


def _coreset_ctes() -> list[str]:
    ctes = [_PTS, _prepared(BUCKETS)]
    ctes += _seed_ctes("prep", K, "coreset", "cs_seed")
    ctes += _lloyd_ctes("prep", "cs_seed", ITERS, "coreset", "cs_cent")
    ctes.append(_nearest("prep", "cs_cent", "cs_asg"))
    ctes.append("cs_w AS (SELECT bucket, cid, sum(w)::BIGINT AS w FROM cs_asg GROUP BY bucket, cid)")
    ctes.append("core AS (SELECT c.bucket, c.cid, c.c, w.w FROM cs_cent c JOIN cs_w w USING (bucket, cid))")
    return ctes


def _recluster_ctes() -> list[str]:
    ctes = _coreset_ctes()
    ctes.append(f"rc_pts AS (SELECT 0::INT AS bucket, bucket::BIGINT * {K} + cid AS id, c AS p, w FROM core WHERE w > 0)")
    ctes += _seed_ctes("rc_pts", K, "recluster", "rc_seed")
    ctes += _lloyd_ctes("rc_pts", "rc_seed", ITERS, "recluster", "final")
    return ctes


def _objective(cent: str) -> str:
    return (
        f"SELECT round(avg(d), {DIGITS}) AS objective FROM ("
        f"SELECT p.id, min(list_distance(p.p, c.c)) AS d FROM pts p CROSS JOIN {cent} c GROUP BY p.id)"
    )


def _vectors() -> dict[str, str]:
    fixed = _FIRST.format(k=K_FIXED)
    one = _FIRST.format(k=1).replace("fixed AS", "ref AS")
    wpts = "wpts AS (SELECT 0::INT AS bucket, vec_id AS id, CAST(embedding AS DOUBLE[]) AS p, (label + 1)::BIGINT AS w FROM embeddings)"
    fixed_b = "fixed_b AS (SELECT 0::INT AS bucket, cid, c FROM fixed)"
    upts = "upts AS (SELECT 0::INT AS bucket, id, p, 1::BIGINT AS w FROM pts)"

    q: dict[str, str] = {}
    q["parse_vectors"] = f"""
SELECT vec_id, len(embedding)::BIGINT AS dim, embedding[1]::DOUBLE AS first,
       round(list_sum(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE)), {DIGITS}) AS sumsq
FROM embeddings"""
    q["vec_distance"] = _with(
        [_PTS, one],
        f"SELECT p.id AS vec_id, round(pow(list_distance(p.p, r.c), 2), {DIGITS}) AS d2, "
        f"round(list_distance(p.p, r.c), {DIGITS}) AS d FROM pts p CROSS JOIN ref r",
    )
    near = _nearest("pts", "fixed", "asg", keys="")
    q["vec_assign"] = _with(
        [_PTS, fixed, near], f"SELECT id AS vec_id, cid::BIGINT AS cid, round(d, {DIGITS}) AS d FROM asg"
    )
    q["vec_objective"] = _with([_PTS, fixed], _objective("fixed"))
    q["vec_weights"] = _with(
        [_PTS, fixed, near], "SELECT cid::BIGINT AS cid, count(*)::BIGINT AS w FROM asg GROUP BY cid"
    )
    q["vec_centroid_update"] = _with(
        [_PTS, fixed, fixed_b, wpts] + _lloyd_ctes("wpts", "fixed_b", 1, "cu", "newc"),
        _explode("newc", "cid::BIGINT AS cid"),
    )
    q["vec_lloyd"] = _with(
        [_PTS, fixed, fixed_b, upts] + _lloyd_ctes("upts", "fixed_b", LLOYD_ROUNDS, "ll", "newc"),
        _explode("newc", "cid::BIGINT AS cid"),
    )
    q["vec_seed_first"] = _with(
        [_PTS, _prepared(1)] + _seed_ctes("prep", 1, "seed", "seeds"), "SELECT id AS vec_id FROM seeds"
    )
    q["vec_seed"] = _with(
        [_PTS, _prepared(1)] + _seed_ctes("prep", K, "seed", "seeds"),
        "SELECT cid::BIGINT AS ord, id AS vec_id FROM seeds",
    )
    q["vec_seed_bucketed"] = _with(
        [_PTS, _prepared(BUCKETS)] + _seed_ctes("prep", K, "seed", "seeds"),
        "SELECT bucket::BIGINT AS bucket, cid::BIGINT AS ord, id AS vec_id FROM seeds",
    )
    q["vec_coreset"] = _with(
        _coreset_ctes(), _explode("core", "bucket::BIGINT AS bucket, cid::BIGINT AS cid, w")
    )
    q["vec_coreset_recluster"] = _with(_recluster_ctes(), _explode("final", "cid::BIGINT AS cid"))
    q["vec_kmedian"] = _with(
        _recluster_ctes()
        + [
            "fin_b AS (SELECT 0::INT AS bucket, cid, c FROM final)",
            upts,
            _nearest("upts", "fin_b", "fin_asg"),
            "sizes AS (SELECT cid, count(*)::BIGINT AS w FROM fin_asg GROUP BY cid)",
            "fin_w AS (SELECT f.cid, f.c, coalesce(s.w, 0)::BIGINT AS w FROM final f LEFT JOIN sizes s USING (cid))",
        ],
        _explode("fin_w", "cid::BIGINT AS cid, w"),
    )
    q["vec_kmedian_objective"] = _with(_recluster_ctes(), _objective("final"))
    q["vec_kmedian_direct"] = _with(
        [_PTS, _prepared(1)]
        + _seed_ctes("prep", K, "direct", "dseed")
        + _lloyd_ctes("prep", "dseed", ITERS, "direct", "dfinal"),
        _explode("dfinal", "cid::BIGINT AS cid"),
    )
    return q


def oracle_sql() -> dict[str, str]:
    out: dict[str, str] = {}
    out.update(NUMERIC)
    out.update(TEXT)
    out.update(_vectors())
    return {k: v.strip() for k, v in out.items()}
