"""Near-duplicate documents by a signature-coordinate inverted join.

Each distinct word-shingle set gets a MinHash signature.  The set is posted
under every (coordinate, value) pair; values that one set alone has can't
collide and are dropped.  Two sets must share at least ``matches`` coordinates, so
with the values ordered by rising frequency they share one within each set's
first ``coordinates - matches + 1`` (its prefix): only prefixes are kept as
lists, and the long lists of common values are skipped.  Shared coordinates
are then counted on whole signatures, and what passes is confirmed on the full
shingle sets.

A list of n sets never becomes n^2 pairs: in each round every set is compared with
a few centres of its lists, and lists whose members hang together already are left
out.  For what is still apart after the rounds the same prefix argument is used once
more, on the full sets: only pairs that can still reach the similarity are confirmed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import marked, marks, save, slices
from .components import components

_M = np.uint64(0xFFFFFFFFFFFFFFFF)
_BASE, _INVERSE = 0x9E3779B97F4A7C15 | 1, pow(0x9E3779B97F4A7C15 | 1, -1, 1 << 64)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[32, *range(9, 14)]] = True
_POWERS: dict[int, np.ndarray] = {}
#: Bytes of text that are hashed at once, and of a call of ``shingle_sets``: a task's memory beside
#: its Arrow batch is a few tens of times the first and a few times the second.
_BLOCK, _SLICE = 1 << 17, 1 << 20


def _mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        size = max(n, 1 << 16)
        out = np.empty(size, np.uint64)
        out[0], filled, step = 1, 1, base
        while filled < size:  # doubling: out[k + filled] = out[k] * base**filled
            more = min(filled, size - filled)
            out[filled : filled + more] = out[:more] * np.uint64(step)
            step = step * step % (1 << 64)
            filled += more
        _POWERS[base] = have = out
    return have


def _words(data: np.ndarray, breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and start of every word; a word also ends at the positions ``breaks``."""
    inside = ~_IS_SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[breaks] = True
    first = inside.copy()
    first[1:] &= ~inside[:-1] | edge[1:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last)
    total = np.cumsum((_LOWER[data].astype(np.uint64) + np.uint64(1)) * _powers(_BASE, len(data))[: len(data)])
    h = total[ends] - np.where(starts > 0, total[starts - 1], np.uint64(0))
    h *= _powers(_INVERSE, len(data))[starts]
    return _mix(h ^ ((ends - starts).astype(np.uint64) << np.uint64(48))), starts


def _word_blocks(data: np.ndarray, breaks: np.ndarray, block: int = _BLOCK) -> tuple[np.ndarray, np.ndarray]:
    """``_words`` over blocks that end at white space, so tables of powers stay small."""
    hashes, starts, at = [], [], 0
    while at < len(data):
        end = min(at + block, len(data))
        while end < len(data):
            space = np.flatnonzero(_IS_SPACE[data[at:end]])
            if len(space):
                end = at + int(space[-1]) + 1
                break
            end = min(end + block, len(data))
        h, s = _words(data[at:end], breaks[(breaks >= at) & (breaks <= end)] - at)
        hashes.append(h)
        starts.append(s + at)
        at = end
    return (np.concatenate(hashes), np.concatenate(starts)) if hashes else (np.empty(0, np.uint64), np.empty(0, np.int64))


def shingle_sets(column: pa.Array, words: int) -> Iterator[np.ndarray]:
    """For each text the sorted distinct hashes of its word shingles.

    A-Z are lower-cased, words are runs without ASCII white space.  A text of
    fewer words is one shingle; one without words, or null, has none.
    """
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[offsets[0] : offsets[-1]] if raw is not None else np.empty(0, np.uint8)
    bounds = offsets - offsets[0]
    hashes, starts = _word_blocks(data, np.unique(bounds))
    at = np.searchsorted(starts, bounds)
    factors = _powers(_BASE, words + 2)[1 : words + 1]
    if len(hashes) >= words:
        n = len(hashes) - words + 1
        runs = sum(hashes[k : k + n] * factors[k] for k in range(words))
        runs = _mix(runs)
    for k in range(len(column)):
        a, b = at[k], at[k + 1]
        if b - a >= words:
            yield np.unique(runs[a : b - words + 1])
        elif b > a:
            short = np.sum(hashes[a:b] * factors[: b - a], dtype=np.uint64) + np.uint64(b - a)
            yield _mix(_mix(np.array([short], np.uint64)))
        else:
            yield np.empty(0, np.uint64)


def _signature(shingles: np.ndarray, coordinates: int) -> np.ndarray:
    """One 64-bit token for each coordinate and its minimum."""
    seeds = _mix(np.arange(1, 2 * coordinates + 1, dtype=np.uint64) * np.uint64(_BASE))
    flip, factor = seeds[:coordinates, None], seeds[coordinates:, None] | np.uint64(1)
    least = np.full(coordinates, _M, np.uint64)
    for k in range(0, len(shingles), 4096):
        part = shingles[None, k : k + 4096] ^ flip
        part *= factor
        np.minimum(least, part.min(axis=1), out=least)
    return _mix(least ^ seeds[:coordinates]).view(np.int64)


def signatures(df: DataFrame, words: int, coordinates: int) -> DataFrame:
    """``id, n_shingles, key, tokens``: set size, identity of the set (null if empty), signature."""

    def run(batches):
        for whole in batches:
            for batch in slices(whole, "text", _SLICE):
                sizes, keys, tokens = [], [], []
                for s in shingle_sets(batch.column(1), words):
                    sizes.append(len(s))
                    if len(s):
                        twice = np.array([np.sum(_mix(s + np.uint64(k)), dtype=np.uint64) for k in (1, 2)] + [len(s)], np.uint64)
                        keys.append(twice.tobytes())
                        tokens.append(_signature(s, coordinates))
                    else:
                        keys.append(None)
                        tokens.append(None)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), pa.array(tokens, pa.list_(pa.int64()))],
                    ["id", "n_shingles", "key", "tokens"],
                )

    kind = df.schema["id"].dataType.simpleString()
    return df.mapInArrow(run, f"id {kind}, n_shingles long, key binary, tokens array<bigint>")


def full_sets(df: DataFrame, words: int, listed: np.ndarray | None = None) -> DataFrame:
    """``id, shingles``: the sorted 64-bit hashes of the whole set.

    With ``listed``, only of ids whose xxhash64 ``marks`` may have had."""
    sent = None if listed is None else df.sparkSession.sparkContext.broadcast(listed)

    def run(batches):
        for whole in batches:
            if sent is not None:
                whole = whole.filter(pa.array(marked(sent.value, whole.column(2).to_numpy())))
            for batch in slices(whole, "text", _SLICE):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array([s.tobytes() for s in shingle_sets(batch.column(1), words)], pa.binary())],
                    ["id", "shingles"],
                )

    rows = df.select("id", "text", F.xxhash64("id").alias("h"))
    return rows.mapInArrow(run, f"id {df.schema['id'].dataType.simpleString()}, shingles binary")


def _marked_rows(df: DataFrame, ids: np.ndarray, among: bool = True) -> DataFrame:
    """The rows of ``df`` whose id's xxhash64 ``ids`` (of ``marks``) may have had, or the others: read and filtered, not shuffled."""
    sent = df.sparkSession.sparkContext.broadcast(ids)

    def run(batches):
        for batch in batches:
            kept = batch.filter(pa.array(marked(sent.value, batch.column("h").to_numpy()) == among))
            yield kept.drop_columns(["h"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema.fields)
    return df.withColumn("h", F.xxhash64("id")).mapInArrow(run, kinds)


def _first_rows(own: DataFrame, nodes: DataFrame) -> DataFrame:
    """The rows of ``own`` (id, key, ...) whose id is a node of ``nodes`` (key, node, n).

    Only rows that may be another one's copy are shuffled: signatures are long.
    """
    own = own.select("id", "key", "tokens")
    copies = own.select("key", "id").join(nodes.where("n > 1"), "key").where("id != node").select(F.xxhash64("id").alias("h"))
    copies = save(copies, "near-copies")
    if copies.isEmpty():
        return own
    ids = marks(copies)
    again = _marked_rows(own, ids).join(nodes.select(F.col("node").alias("id")).distinct(), "id", "left_semi")
    return _marked_rows(own, ids, among=False).unionByName(again.select(*own.columns))


def _with_shared(rows: DataFrame, shared: DataFrame, matches: int) -> DataFrame:
    """``id, tokens`` with about those tokens that are in ``shared``; rows that are left with fewer than ``matches`` go."""
    sent = rows.sparkSession.sparkContext.broadcast(marks(shared.select("token"), each=16))

    def run(batches):
        for batch in batches:
            lists = batch.column(1)
            tokens, lengths = lists.flatten().to_numpy(), lists.value_lengths().to_numpy()
            may = marked(sent.value, tokens)
            row = np.repeat(np.arange(len(lists)), lengths)
            many = np.bincount(row[may], minlength=len(lists)) >= matches
            may &= many[row]
            ends = np.concatenate([[0], np.cumsum(np.bincount(row[may], minlength=len(lists))[many])])
            left = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(tokens[may]))
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(many)), left], ["id", "tokens"])

    return rows.select("id", "tokens").mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, tokens array<bigint>")


def _counted(pairs: DataFrame, active: DataFrame, matches: int) -> DataFrame:
    """The pairs (a, b) that share enough coordinates."""
    side = lambda c, to: active.select(F.col("id").alias(c), F.col("tokens").alias(to))
    both = pairs.join(side("a", "ta"), "a").join(side("b", "tb"), "b")
    return both.where(F.size(F.array_intersect("ta", "tb")) >= matches).select("a", "b")


def _confirm(counted: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that, on full sets, are similar enough."""
    side = lambda df, c, to: df.select(F.col("id").alias(c), F.col("shingles").alias(to))
    # sets are long: only those that a pair needs, and a few more, are shuffled
    needed = lambda c: _marked_rows(sets, marks(counted.select(c).distinct().select(F.xxhash64(c))))
    both = counted.join(side(needed("a"), "a", "sa"), "a").join(side(needed("b"), "b", "sb"), "b").select("a", "b", "sa", "sb")

    def run(batches):
        for batch in batches:
            ok = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                if len(x) > len(y):
                    x, y = y, x
                if 100 * len(x) < percent * len(y):
                    ok.append(False)
                    continue
                at = np.searchsorted(y, x)
                at[at == len(y)] = 0
                common = int(np.count_nonzero(y[at] == x))
                ok.append(100 * common >= percent * (len(x) + len(y) - common))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(ok, pa.bool_()))

    kind = counted.schema["a"].dataType.simpleString()
    return both.mapInArrow(run, f"a {kind}, b {kind}")


def _hang(labels: DataFrame | None, edges: DataFrame) -> DataFrame:
    """``id, component`` after ``edges`` (a, b) join what ``labels`` says so far; components are contracted first."""
    if labels is None:
        return save(components(edges), "near-labels")
    of = lambda c: labels.select(F.col("id").alias(c), F.col("component").alias("of_" + c))
    between = edges.join(of("a"), "a", "left").join(of("b"), "b", "left")
    between = between.select(F.coalesce("of_a", "a").alias("a"), F.coalesce("of_b", "b").alias("b"))
    roots = save(components(between), "near-roots")
    moved = labels.join(roots.select(F.col("id").alias("component"), F.col("component").alias("root")), "component", "left")
    moved = moved.select("id", F.coalesce("root", "component").alias("component"))
    return save(moved.unionByName(roots.join(labels.select("id"), "id", "left_anti")), "near-labels")


def _stars(lists: DataFrame, salt: int, each: int) -> DataFrame:
    """Up to ``each`` pairs (a, b) for a member: with the centres of its lists (token, id, component, common).

    A list's centre is the member whose values are the commonest: of edited copies the
    one nearest to their common text.  After the first round (salt 0) only a drawn part
    of a list's members can be its centre, so that other pairs are tried.
    """
    drawn = F.lit(True) if salt == 0 else F.pmod(F.xxhash64("id", "token", F.lit(salt)), F.lit(8)) == 0
    centres = lists.groupBy("token").agg(F.max(F.struct(drawn.alias("drawn"), "common", "id", "component")).alias("c"))
    other = lists.join(centres, "token").where("component != c.component")
    best = other.groupBy("id").agg(F.slice(F.sort_array(F.collect_set(F.struct("c.common", "c.id")), asc=False), 1, each).alias("best"))
    pairs = best.select("id", F.explode("best.id").alias("centre"))
    return pairs.select(F.least("id", "centre").alias("a"), F.greatest("id", "centre").alias("b")).distinct()


def _apart(lists: DataFrame, labels: DataFrame) -> DataFrame:
    """The lists whose members belong to several components, with each member's component."""
    got = lists.join(labels, "id", "left").withColumn("component", F.coalesce("component", "id"))
    got = save(got, "near-lists")
    several = got.groupBy("token").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x != y").select("token")
    return save(got.join(several, "token", "left_semi"), "near-apart")


def _across(apart: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs of different components that can reach the similarity, by prefixes of full sets.

    With a set's shingles ordered by rising frequency, a similar set shares one
    of the first ``size - ceil(percent * size) + 1``.  Shingles that one component alone
    has come first and need no list, so sets with many of them drop out.  Two sets
    meet only at places from which the rest of both still reaches the overlap that
    their sizes ask for; the first shingle they share is such a place if they are similar.
    """
    who = apart.select("id", "component").distinct()
    rows = sets.join(who, "id").select("id", "component", "shingles")

    def spread(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                values = np.frombuffer(batch.column(2)[k].as_buffer(), np.int64)
                n = len(values)
                one = lambda c: pa.array([batch.column(c)[k].as_py()] * n, batch.schema.field(c).type)  # noqa: E731, B023
                size = pa.array(np.full(n, n, np.int64))
                yield pa.RecordBatch.from_arrays([one(0), one(1), size, pa.array(values)], ["id", "component", "size", "shingle"])

    kind = apart.schema["id"].dataType.simpleString()
    posts = save(rows.mapInArrow(spread, f"id {kind}, component {kind}, size long, shingle long"), "near-shingles")
    shared = posts.groupBy("shingle").agg(F.count("*").alias("n"), F.min("component").alias("x"), F.max("component").alias("y"))
    shared = shared.where("x != y").select("shingle", "n")
    own = Window.partitionBy("id", "size")
    ranked = (
        posts.join(shared, "shingle")
        .withColumn("rank", F.row_number().over(own.orderBy("n", "shingle")) + F.col("size") - F.count("*").over(own))
        .where(F.col("rank") <= F.col("size") - F.ceil(F.col("size") * percent / 100) + 1)
    )
    lists = save(ranked.select("shingle", "id", "component", "size", (F.col("size") - F.col("rank") + 1).alias("rest")), "near-shingle-lists")
    left = lists.select("shingle", F.col("id").alias("a"), F.col("component").alias("ca"), F.col("size").alias("na"), F.col("rest").alias("ra"))
    right = lists.select("shingle", F.col("id").alias("b"), F.col("component").alias("cb"), F.col("size").alias("nb"), F.col("rest").alias("rb"))
    reach = F.least("ra", "rb") * (100 + percent) >= (F.col("na") + F.col("nb")) * percent
    return left.join(right, "shingle").where("a < b and ca != cb").where(reach).select("a", "b").distinct()


def near_duplicates(
    df: DataFrame,
    words: int = 5,
    percent: int = 80,
    coordinates: int = 48,
    matches: int = 26,
    rounds: int = 4,
    common_values: int = 8,
    centres: int = 4,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Per row ``n_shingles``, ``component_id`` and ``kept``.

    Texts are linked if their sets' Jaccard similarity is ``percent`` / 100 or
    more; a pair at just 0.8 shares fewer than 26 of 48 coordinates, and is lost,
    with a chance of about 2 in 100,000.  ``component_id`` is the smallest id
    reachable, ``kept`` marks rows that bear it.  Null and empty texts link
    with nothing.  Rows with one id are one node.  Null ids link with nothing:
    their component is null and they are kept.  Other columns are not read; an
    empty table gives an empty result.
    """
    src = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    found = save(signatures(src, words, coordinates), "near-signatures")

    # one node for all copies of a set
    own = found.where("key is not null and id is not null")
    nodes = save(own.groupBy("key").agg(F.min("id").alias("node"), F.count("*").alias("n")), "near-nodes")
    first = _first_rows(own, nodes)
    posts = lambda rows: rows.select("id", F.explode("tokens").alias("token"))
    shared = save(posts(first).groupBy("token").agg(F.count("*").alias("n")).where("n > 1"), "near-shared")
    # most sets share too few tokens with any other: theirs are not shuffled again
    hits = posts(_with_shared(first, shared, matches)).join(shared, "token")
    active = hits.groupBy("id").agg(F.sort_array(F.collect_set(F.struct("n", "token"))).alias("hits")).where(F.size("hits") >= matches)
    active = save(active, "near-active")
    prefix = active.select("id", F.explode(F.slice("hits", F.lit(1), F.size("hits") - (matches - 1))).alias("hit")).select("id", "hit.token")

    # lists of the same members lead to the same pairs: one of them is enough
    who = F.xxhash64("id")
    lists = prefix.groupBy("token").agg(
        F.count("*").alias("n"), F.min("id").alias("least"), F.max("id").alias("most"), F.bit_xor(who).alias("x"), F.sum(who.cast("decimal(38,0)")).alias("s")
    )
    lists = lists.where("n > 1").groupBy("n", "least", "most", "x", "s").agg(F.min("token").alias("token")).select("token")
    lists = save(prefix.join(lists, "token"), "near-prefixes")

    signature = active.select("id", F.transform("hits", lambda x: x["token"]).alias("tokens"))
    listed = save(lists.select("id").distinct(), "near-listed")
    if listed.count() <= 1 << 24:  # texts are filtered where they are read, not shuffled; a few more pass
        sets = full_sets(src, words, marks(listed.select(F.xxhash64("id"))))
    else:
        sets = full_sets(src.join(listed, "id", "left_semi"), words)
    sets = save(sets, "near-sets")
    tried = []  # no pair is compared on full sets twice

    def confirm(pairs: DataFrame) -> DataFrame:
        for earlier in tried:
            pairs = pairs.join(earlier, ["a", "b"], "left_anti")
        tried.append(save(_counted(pairs, signature, matches), "near-counted"))
        return save(_confirm(tried[-1], sets, percent), "near-edges")


    # first each set's commonest values: they join large groups at once, whose prefixes
    # hold only what few members have in common
    weights = active.withColumn("common", F.aggregate("hits", F.lit(0).cast("long"), lambda n, x: n + x["n"]))
    common = weights.join(listed, "id", "left_semi").select(
        "id", F.col("id").alias("component"), "common", F.explode(F.slice("hits", -common_values, common_values)).alias("hit")
    )
    labels = _hang(None, confirm(_stars(common.withColumn("token", F.col("hit.token")), 0, centres)))
    members = lists.select("token", "id").join(weights.select("id", "common"), "id")
    apart = _apart(members, labels)
    for r in range(1, rounds):
        if apart.isEmpty():
            break
        labels = _hang(labels, confirm(_stars(apart, r - 1, centres)))
        apart = _apart(members, labels)
    if not apart.isEmpty():
        labels = _hang(labels, confirm(_across(apart, sets, percent)))

    roots = labels.select(F.col("id").alias("node"), "component")
    of_key = nodes.join(roots, "node", "left").select("key", F.coalesce("component", "node").alias("component"))
    out = found.select("id", "n_shingles", "key").join(of_key, "key", "left")
    # rows with one id but different texts: the id's smallest component
    component = F.coalesce("component", "id")
    return out.select(
        F.col("id").alias(id_col),
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
        "key",
    )


def keep_one(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``df`` with one row of each group of near duplicates, that of the smallest id; columns stay.

    Rows with a null id, and texts without words, stay.  Of rows that share an id one stays.
    """
    found = near_duplicates(df, id_col=id_col, text_col=text_col, **options)
    stay = found.where(F.col("kept") & F.col(id_col).isNotNull()).groupBy(id_col).agg(F.count("*").alias("n"))
    stay = save(stay, "near-kept")
    own = F.col(f"`{id_col}`")
    rows = lambda some: df.join(stay.where(some).select(id_col), id_col, "left_semi").select(*df.columns)
    out = rows("n = 1").unionByName(df.where(own.isNull()))
    again = stay.where("n > 1")
    return out if again.isEmpty() else out.unionByName(rows("n > 1").dropDuplicates([id_col]))
