"""MinHash near-dedup with ProbMinHash signatures.

Every shingle of a text (five words, A-Z lower-cased, punctuation out) is a
Poisson process whose rate is its weight, drawn by hash so that all texts agree
on it; each arrival goes to a random register, and a register keeps the shingle
that arrives first. Two signatures agree in a register with the probability
Jaccard similarity of the weighted shingles. Each text has two: one weighs a
shingle by how often the text has it; in the other each distinct shingle has
weight one, and the similarity is the Jaccard similarity of sets itself. A link
is one of sets, so the second must propose every link alone; the first adds
bands where what a text repeats counts. Arrivals are made up to a time by which
all registers are usually filled; later ones cannot matter, and only texts with
an empty register go on.

Equal texts are one node from here on. Bands of both signatures put texts in
buckets. In each bucket every text is compared exactly (Jaccard of the shingle
sets) with the bucket's most central text, so a bucket costs as many rows as it
has texts. Links make components. Where a bucket still holds more than one
component, texts whose shared shingles cannot reach the threshold with any
other are ruled out, and up to ``SLOTS`` of the texts outside the bucket's main component
are compared with all its others at a time, until each pair of a bucket is
compared, ruled out or known to be connected. No link within a bucket is lost,
and no round makes all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quern.llm.common import WordHashes, folded_words, map_arrow, mix, rolling, row_key, slices, texts
from quern.session import ScratchTables

SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 24, 5  # of sets: at a similarity of 0.8 a pair shares a band with 99.99 %
WEIGHTED_BANDS = 8  # of counted shingles: at a probability similarity of 0.8 with 96 %
SLOTS = 64
SALTS = 64  # cells of a node's neighbourhood in the star steps
SLICE_BYTES = 1 << 20
KNOWN_WORDS = 1 << 18  # whose hashes a task remembers


# ---------------------------------------------------------------- signatures


def shingles(words: list[list[bytes]], hashes: WordHashes, n: int = SHINGLE) -> tuple[np.ndarray, ...]:
    """Of all distinct shingles: document, hash, and how often it occurs there;
    in order of documents. A text of fewer than ``n`` words, but not none, is
    one shingle."""
    sizes = np.array([len(w) for w in words], np.int64)
    h = np.concatenate([np.empty(0, np.uint64), *(hashes.array(w) for w in words)])
    starts = np.concatenate([[0], np.cumsum(sizes)])
    doc = np.repeat(np.arange(len(words)), sizes)
    left = starts[1:][doc] - np.arange(len(h))
    full = left >= n
    value = np.zeros(len(h), np.uint64)
    if len(h) >= n:
        value[: len(h) - n + 1] = rolling(h, n)
    for d in np.flatnonzero((sizes > 0) & (sizes < n)):
        value[starts[d]] = xxhash.xxh64_intdigest(b" ".join(words[d]), 5)
        full[starts[d]] = True
    at = np.flatnonzero(full)
    value = mix(value[at])
    _, first, count = np.unique(value ^ mix(doc[at].astype(np.uint64) + np.uint64(1)), return_index=True, return_counts=True)
    order = np.argsort(first, kind="stable")
    first, count = first[order], count[order]
    return doc[at[first]], value[first], count


def signatures(doc: np.ndarray, element: np.ndarray, weight: np.ndarray, n_docs: int, m: int) -> np.ndarray:
    """ProbMinHash: the first element of each of ``m`` registers, one row per
    document; documents without elements have zeros."""
    out = np.zeros((n_docs, m), np.uint64)
    total = np.bincount(doc, weights=weight, minlength=n_docs)
    todo = total > 0
    until = np.divide(m * (np.log(m) + 2.0), total, out=np.zeros(n_docs), where=todo)
    while todo.any():
        some = todo[doc]
        d, e, w = doc[some], element[some], weight[some].astype(float)
        t = np.zeros(len(d))
        times, winner = np.full(n_docs * m, np.inf), np.zeros(n_docs * m, np.uint64)
        j = 0
        while len(d):
            j += 1
            x = mix(e + np.uint64(0x9E3779B97F4A7C15 * j % (1 << 64)))
            t = t - np.log(((x >> np.uint64(11)).astype(float) + 0.5) * 2.0**-53) / w
            soon = t <= until[d]  # the others' later arrivals are later still
            d, e, w, t, x = d[soon], e[soon], w[soon], t[soon], x[soon]
            at = d * m + ((x & np.uint64(0x7FF)).astype(np.int64) * m >> 11)
            np.minimum.at(times, at, t)
            mine = times[at] == t
            winner[at[mine]] = e[mine]
        filled = np.isfinite(times.reshape(n_docs, m)).all(axis=1)
        done = todo & filled
        out[done] = winner.reshape(n_docs, m)[done]
        todo &= ~filled
        until[todo] *= 2
    return out


def band_keys(signature: np.ndarray, bands: int, rows: int, before: int = 0) -> np.ndarray:
    """One 64-bit key per band; ``before`` bands have keys of their own already."""
    z = signature.reshape(len(signature), bands, rows)
    key = np.arange(before + 1, before + bands + 1, dtype=np.uint64)[None, :] * np.uint64(0xD1342543DE82EF95)
    for r in range(rows):
        key = mix(key ^ z[:, :, r]) + np.uint64(r)
    return key


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes = WordHashes(KNOWN_WORDS)
    for batch in slices(batches, "text", SLICE_BYTES):
        words = [folded_words(x) for x in texts(batch.column("text"))]
        doc, element, count = shingles(words, hashes)
        n = np.bincount(doc, minlength=len(words))
        sets = band_keys(signatures(doc, element, np.ones(len(doc)), len(words), BANDS * ROWS), BANDS, ROWS)
        counted = band_keys(signatures(doc, element, count, len(words), WEIGHTED_BANDS * ROWS), WEIGHTED_BANDS, ROWS, BANDS)
        keys = np.concatenate([sets, counted], axis=1).view(np.int64)
        yield pa.RecordBatch.from_arrays(
            [
                *(batch.column(c) for c in ("r1", "r2", "doc_id")),
                pa.array([xxhash.xxh3_128_digest(b" ".join(w)) if w else None for w in words], pa.binary()),
                pa.array(n, pa.int32()),
                pa.FixedSizeListArray.from_arrays(pa.array(keys.ravel()), BANDS + WEIGHTED_BANDS).cast(pa.list_(pa.int64())),
            ],
            names=["r1", "r2", "doc_id", "c", "n", "bands"],
        )


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes = WordHashes(KNOWN_WORDS)
    for batch in slices(batches, "text", SLICE_BYTES):
        words = [folded_words(x) for x in texts(batch.column("text"))]
        doc, element, _ = shingles(words, hashes)
        ends = np.searchsorted(doc, np.arange(len(words) + 1)).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(element.view(np.int64)))
        yield pa.RecordBatch.from_arrays([batch.column("c"), lists], names=["c", "set"])


# ---------------------------------------------------------------- components


def _with_least(edges: DataFrame) -> DataFrame:
    """``u, v`` with ``m``, the least ``v`` of the ``u``. The least goes to each
    cell (a hash of ``v``) that the node has an edge in, and the edges meet it
    by node and cell, so a hot node's edges are spread over ``SALTS`` places;
    a node of few edges costs no more rows than it has edges."""
    salted = edges.withColumn("cell", F.pmod(F.xxhash64("v"), F.lit(SALTS)).cast("int"))
    least = salted.groupBy("u").agg(F.min("v").alias("m"), F.collect_set("cell").alias("cells"))
    return salted.join(least.select("u", "m", F.explode("cells").alias("cell")), ["u", "cell"]).drop("cell")


def components(links: DataFrame, tables: ScratchTables) -> DataFrame:
    """``c, comp`` for every node of ``links`` (a, b): its component's least
    node. Large-star and small-star steps (Kiveris et al., 2014) by aggregation
    and join, until nothing changes; no neighbourhood is ever gathered."""
    edges = tables.put(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    print_ = lambda df: tuple(df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
    before = None
    while (now := print_(edges)) != before:
        before = now
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        far = _with_least(both).where("v > u").select(F.col("v").alias("u"), F.least("u", "m").alias("v"))
        large = tables.put(far.distinct(), "large")
        # a node's edge to its least stays; its other neighbours get one to that least
        small = _with_least(large).select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        edges = tables.put(small.distinct(), "small")
    roots = edges.select(F.col("v").alias("c"), F.col("v").alias("comp")).distinct()
    return tables.put(edges.select(F.col("u").alias("c"), F.col("v").alias("comp")).unionByName(roots), "components")


# -------------------------------------------------------------------- linking


def _common(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``a, b, both, s`` of the (written) pairs: the sizes of the two sets
    together, and of what they share. One set of each pair crosses the network
    with it; the other is joined where the pair ends."""
    one = pairs.join(sets.select(F.col("c").alias("b"), F.col("set").alias("y")), "b")
    two = one.join(sets.select(F.col("c").alias("a"), F.col("set").alias("x")), "a")
    return two.select("a", "b", (F.size("x") + F.size("y")).alias("both"), F.size(F.array_intersect("x", "y")).alias("s"))


def _links(common: DataFrame, threshold: float) -> DataFrame:
    return common.where(F.col("s") >= threshold * (F.col("both") - F.col("s"))).select("a", "b")


def _centred(members: DataFrame, tables: ScratchTables) -> DataFrame:
    """``key, c, n, a``: members with the most central text ``a`` of their
    bucket, that whose own buckets hold the most texts."""
    score = tables.put(members.groupBy("c").agg(F.sum("size").alias("score")), "scores")
    centre = members.join(score, "c").groupBy("key").agg(F.max(F.struct("score", "c")).alias("top"))
    centre = tables.put(centre.select("key", F.col("top.c").alias("a")), "centres")
    return tables.put(members.select("key", "c", "n").join(centre, "key"), "centred")


def _open(members: DataFrame, tables: ScratchTables) -> DataFrame:
    """Members of the buckets with more than one component, with the bucket's
    main component (that of the most members) and its least set size."""
    each = members.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("k"), F.min("n").alias("n"))
    keys = each.groupBy("key").agg(
        F.count(F.lit(1)).alias("comps"), F.max(F.struct("k", "comp"))["comp"].alias("main"), F.min("n").alias("least")
    )
    keys = tables.put(keys.where("comps > 1").drop("comps"), "open-keys")
    return tables.put(members.join(keys, "key"), "open")


def _linkable(members: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """Members that may still link, and how many of their shingles some other
    open text, or the centre of an open bucket, has (``shared``). A partner has
    at least ``threshold`` times a text's shingles, and at least the bucket's
    least number, and by this shares so many with it; a shingle that no other
    of these texts has is shared with none."""
    asked = members.select("c").unionByName(members.select(F.col("a").alias("c"))).distinct()
    each = sets.join(asked, "c", "left_semi").select("c", F.explode("set").alias("s"))
    alone = each.groupBy("s").agg(F.count(F.lit(1)).alias("k"), F.min("c").alias("c")).where("k = 1").groupBy("c").agg(F.count(F.lit(1)).alias("alone"))
    known = members.join(alone, "c", "left").withColumn("shared", F.col("n") - F.coalesce("alone", F.lit(0)))
    needed = F.lit(threshold / (1 + threshold)) * (F.col("n") + F.greatest(threshold * F.col("n"), F.col("least")))
    return known.where(F.col("shared") >= needed - 1e-6).select("key", "c", "n", "s", "shared", "comp")


def _with_components(members: DataFrame, comps: DataFrame) -> DataFrame:
    own = [c for c in members.columns if c != "comp"]
    return members.select(own).join(comps, "c", "left").select(*own, F.coalesce("comp", "c").alias("comp"))


def linked(members: DataFrame, sets: DataFrame, tables: ScratchTables, threshold: float) -> DataFrame:
    """``c, comp`` of every text that has a link."""
    centred = _centred(members, tables)
    stars = tables.put(centred.where("c != a").select("a", F.col("c").alias("b")).distinct(), "star-pairs")
    stars = tables.put(_common(stars, sets), "stars")
    links = tables.put(_links(stars, threshold), "links")
    comps = components(links, tables)

    with_s = centred.join(stars.select("a", F.col("b").alias("c"), "s"), ["a", "c"], "left")
    with_s = with_s.select("key", "c", "n", "a", F.coalesce("s", "n").alias("s"))  # s: shared with the centre
    left = _open(_with_components(with_s, comps), tables)
    left = _open(tables.put(_linkable(left, sets, threshold), "linkable"), tables)
    sets = tables.put(sets.join(left.select("c").distinct(), "c", "left_semi"), "open-sets")
    # what two texts share at most: inside the centre's set, and outside it, where it must be shared with some text
    reach = F.least("s", "hs") + F.greatest(F.lit(0), F.least(F.col("shared") - F.col("s"), F.col("hshared") - F.col("hs")))
    turn = 0
    while not left.isEmpty():
        # a pair of two components has one text at least that is not of the main one
        turn += 1
        slot = F.pmod(F.xxhash64("c", F.lit(turn)), F.lit(SLOTS))
        own = ("c", "n", "s", "shared", "comp")
        heads = left.where("comp != main").groupBy("key", slot.alias("slot")).agg(F.min(F.struct(*own)).alias("h"))
        heads = tables.put(heads.select("key", *[F.col(f"h.{x}").alias(f"h{x}") for x in own]), "heads")
        needed = F.lit(threshold / (1 + threshold)) * (F.col("n") + F.col("hn")) - 1e-6
        pairs = (
            left.join(heads, "key")
            .where("comp != hcomp")
            .where(F.least("n", "hn") >= threshold * F.greatest("n", "hn"))
            .where((F.least("shared", "hshared") >= needed) & (reach >= needed))
            .select(F.least("c", "hc").alias("a"), F.greatest("c", "hc").alias("b"))
            .distinct()
        )
        more = tables.put(_links(_common(tables.put(pairs, "pairs"), sets), threshold), "more-links")
        rest = left.drop("main", "least").join(heads.select("key", F.col("hc").alias("c")), ["key", "c"], "left_anti")
        if not more.isEmpty():
            links = links.unionByName(more)
            comps = components(links, tables)
            rest = _with_components(rest, comps)
        left = _open(tables.put(rest.select("key", *own), "rest"), tables)
    return comps


def _classified(docs: DataFrame, id_col: str, text_col: str, threshold: float) -> DataFrame:
    """``r1, r2, doc_id, first`` of every row: ``first`` is the least (doc_id,
    r1, r2) of its class, its own if the text has no words."""
    tables = ScratchTables(docs.sparkSession, "minhash")
    inp = docs.select(*row_key(F.col(id_col), F.col(text_col)), F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = inp.schema["doc_id"].dataType.simpleString()
    rows = tables.put(
        map_arrow(inp, _sketch, f"r1 bigint, r2 bigint, doc_id {kind}, c binary, n int, bands array<bigint>"), "rows"
    )
    nodes = rows.where("n > 0").groupBy("c").agg(
        F.min(F.struct("doc_id", "r1", "r2")).alias("first"), F.first("n").alias("n"), F.first("bands").alias("bands")
    )
    nodes = tables.put(nodes, "texts")
    keyed = nodes.select("c", "n", F.explode("bands").alias("key"))
    sizes = tables.put(keyed.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1"), "sizes")
    members = tables.put(keyed.join(sizes, "key"), "members")

    wanted = tables.put(
        nodes.join(members.select("c").distinct(), "c", "left_semi").select(F.col("first.r1").alias("r1"), F.col("first.r2").alias("r2"), "c"),
        "wanted",
    )
    # merged at every size: the wanted texts are a share of all, never a small table
    read = inp.select("r1", "r2", "text").join(wanted.hint("merge"), ["r1", "r2"]).dropDuplicates(["r1", "r2"])  # rows that repeat
    sets = map_arrow(read.select("c", "text"), _sets, "c binary, set array<bigint>")
    comps = linked(members, tables.put(sets, "sets"), tables, threshold)
    named = nodes.select("c", "first").join(comps, "c", "left").select("c", "first", F.coalesce("comp", "c").alias("comp"))
    firsts = named.groupBy("comp").agg(F.min("first").alias("class_first"))
    classes = tables.put(named.join(firsts, "comp").select("c", F.col("class_first").alias("first")), "classes")
    tables.keep(rows, classes)
    return rows.select("r1", "r2", "doc_id", "c").join(classes, "c", "left").select(
        "r1", "r2", "doc_id", F.coalesce("first", F.struct("doc_id", "r1", "r2")).alias("first")
    )


def classes(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, class_id`` of every row: the least id of its class, the
    documents connected by links (equal words, or a Jaccard similarity of
    five-word shingles of at least ``threshold``).

    A text without words (null, empty) is in no class but that of its own id.
    A text of one to four words is one shingle. Null ids come first.
    """
    done = _classified(docs, id_col, text_col, threshold)
    return done.select("doc_id", F.col("first.doc_id").alias("class_id"))


def dedup(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with one row of each class: that of the least id (of rows that
    tie in id, one). Texts without words stay, unless the whole row's id and
    text repeat."""
    tables = ScratchTables(docs.sparkSession, "near-dedup")
    done = _classified(docs, id_col, text_col, threshold)
    gone = done.where((F.col("r1") != F.col("first.r1")) | (F.col("r2") != F.col("first.r2"))).select("r1", "r2").distinct()
    base = docs.select(*row_key(F.col(id_col), F.col(text_col)), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    kept = base.join(tables.put(gone, "gone"), ["r1", "r2"], "left_anti")
    once = Window.partitionBy("r1", "r2").orderBy(F.xxhash64("row"))
    return kept.withColumn("nth", F.row_number().over(once)).where("nth = 1").select("row.*")
