"""Jaccard join of documents on word shingles, exact, by PartEnum signatures.

Sets are put into size bands. In a band a similarity of 80 % bounds the symmetric difference of two sets
by some k. The shingle domain is cut into n1 > k partitions: similar sets agree on at least n1 - k of them.
Each partition's content is one signature, so similar sets share a signature. For k up to 3 the domain is
cut into k + 3 parts and every choice of 3 parts makes a signature. Pairs from neighbouring bands get
signatures of their own.

More partitions than needed (``spare``) are made, so that similar sets agree on more than ``spare`` of
them. Up to ``spare`` useless signatures of a set (of empty partitions, or shared by many) can then be
left out without losing a link.

Sets that share a signature are compared with the least of them only. Their components are found. Then the sets
of a signature that are in different components are compared with each other, each pair at the first signature it
shares, unless parities of their shingles already show too many differences: first parities folded to a few columns,
which are compared without an array for each pair, then all of them. So no copies are expanded into pairs, and no link
between components is lost.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gleanery.llm.buckets import FLUSH_BYTES, bucket_count, bucket_of, dealt, pack
from gleanery.llm.common import checked, only, short_batches, staged_count
from gleanery.llm.components import components
from gleanery.llm.words import PART, buffers, in_chunks, mix, sequences, spans_hash, words_of
from gleanery.session import stage

SHINGLE = 5
PERCENT = 80
LEAST_PERCENT = 64  # below it similar sets may lie two bands apart and share no signature
SKETCH = 8  # shingles for each counter of a sketch
SHORT = 8  # 64-bit words of the parities that are compared first
EARLIER = 12  # signatures before one at which a pair may have met already
FOUND = "kind string, a long, b long, n long, m long, c long, id long, bucket int, hashes binary, places binary, bits array<long>, short array<long>"
SETS = "name long, rep long, n long, shingles binary"


def bands(upto: int) -> list[int]:
    """First sizes of the bands, each about 1.56 times the one before."""
    edges = [1]
    while edges[-1] <= upto:
        edges.append(max(edges[-1] + 1, edges[-1] * 25 // 16))
    return edges


_EDGES = np.array(bands(1 << 40))


def difference(a: int, b: int, percent: int = PERCENT) -> int:
    """Largest symmetric difference of sets of these sizes that reach the similarity."""
    return (a + b) * (100 - percent) // (100 + percent)


def spare(k: int) -> int:
    return 4 + k // 6


def families(n: int, percent: int = PERCENT) -> list[tuple[int, int]]:
    """Signature families of a set of ``n`` shingles: a number, and the k of its pairs."""
    if not n:
        return []
    band = int(np.searchsorted(_EDGES, n, side="right")) - 1
    low, high = int(_EDGES[band]), int(_EDGES[band + 1])
    found = [(3 * band, difference(high - 1, high - 1, percent))]
    reach = lambda size: size * 100 // percent
    if n <= reach(low - 1):
        found.append((3 * band + 1, difference(low - 1, reach(low - 1), percent)))
    if reach(n) >= high:
        found.append((3 * (band + 1) + 1, difference(high - 1, reach(high - 1), percent)))
    # Equal sets are one node, so a family in which only equal sets are similar needs no signature.
    return [(f, k) for f, k in found if k > 0]


def signatures(shingles: np.ndarray, percent: int = PERCENT) -> tuple[np.ndarray, int]:
    """Signatures of a sorted set, and how many of them could still be left out."""
    made, allowed = [], 1 << 30
    inner = np.zeros(len(shingles) + 1, np.uint64)
    np.cumsum(mix(shingles, 1), out=inner[1:])
    for family, k in families(len(shingles), percent):
        few = k <= 3
        parts = k + 3 if few else k + 1 + spare(k)
        edges = (np.arange(1, parts, dtype=object) * (1 << 64) // parts).astype(np.uint64) if few else _cuts(parts)
        cuts = np.concatenate([[0], np.searchsorted(shingles, edges), [len(shingles)]])
        sums = inner[cuts[1:]] - inner[cuts[:-1]]
        if few:
            chosen = np.array(list(combinations(range(parts), 3)))
            keys = mix(sums + mix(np.arange(parts, dtype=np.uint64), 3), 4)[chosen].sum(axis=1, dtype=np.uint64)
            allowed = 0
        else:
            filled = cuts[1:] > cuts[:-1]
            empty = int((~filled).sum())
            if empty <= spare(k):
                allowed = min(allowed, spare(k) - empty)
            else:
                filled[:] = True
                allowed = 0
            keys = (sums + mix(np.arange(parts, dtype=np.uint64), 3))[filled]
        made.append(mix(mix(keys, 5) + np.uint64(family), 6))
    return (np.concatenate(made) if made else np.zeros(0, np.uint64)), allowed


_cut_points: dict[int, np.ndarray] = {}


def _cuts(parts: int) -> np.ndarray:
    if parts not in _cut_points:
        if len(_cut_points) > 5000:
            _cut_points.clear()
        _cut_points[parts] = np.array([i * (1 << 64) // parts for i in range(1, parts)], np.uint64)
    return _cut_points[parts]


def shingle_sets(texts: pa.Array, size: int = SHINGLE) -> Iterator[np.ndarray]:
    """The sorted distinct shingle fingerprints of each text; a shorter text is one shingle."""
    words = words_of(texts, lower=True)
    index, hashes = sequences(words, size)
    edges = np.searchsorted(index, words.first)
    for d in range(len(texts)):
        begin, end = words.first[d], words.first[d + 1]
        if end - begin >= size:
            yield np.unique(hashes[edges[d] : edges[d + 1]])
        elif end > begin:
            yield mix(spans_hash(words.hash[begin:end], np.array([0]), np.array([end - begin])), int(end - begin))
        else:
            yield hashes[:0]


def set_names(shingles: np.ndarray) -> tuple[int, int]:
    """Two 64-bit names of a set."""
    sums = np.array([mix(shingles, seed).sum(dtype=np.uint64) for seed in (11, 13)])
    first, second = mix(sums + np.uint64(len(shingles)), 12).astype(np.int64).tolist()
    return first, second


def _batch(rows: dict[str, list], schema: pa.Schema) -> pa.RecordBatch:
    count = max(len(v) for v in rows.values())
    return pa.RecordBatch.from_arrays(
        [pa.array(rows[f.name], f.type) if f.name in rows else pa.nulls(count, f.type) for f in schema], schema=schema
    )


def sketch_of(shingles: np.ndarray) -> bytes:
    """Counts of shingles by the upper bits of their fingerprints, about one counter for ``SKETCH`` of them."""
    bits = max(0, int(len(shingles) // SKETCH).bit_length() - 1)
    at = (shingles >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(shingles), np.int64)
    return np.bincount(at, minlength=1 << bits).clip(max=255).astype(np.uint8).tobytes()


def parity_bits(shingles: np.ndarray) -> np.ndarray:
    """Parities of the shingles by the lower bits of their fingerprints, at least four places a shingle, as 64-bit words."""
    places = max(64, 1 << (4 * len(shingles) - 1).bit_length()) if len(shingles) else 64
    odd = np.bincount((shingles & np.uint64(places - 1)).astype(np.int64), minlength=places) & 1
    return np.packbits(odd.astype(bool), bitorder="little").view("<i8")


def short_parities(bits: np.ndarray) -> np.ndarray | None:
    """Parities folded to ``SHORT`` words; none for a set that has fewer."""
    return np.bitwise_xor.reduce(bits.reshape(-1, SHORT), axis=0) if len(bits) >= SHORT else None


def least_odd(one: Column, two: Column) -> Column:
    """A lower bound of the symmetric difference of two sets: each shingle of only one of them turns one parity.

    For sets whose sizes differ less than twofold; the longer parities are folded to the length of the shorter.
    """
    xor = lambda x, y: x.bitwiseXOR(y)

    def folded(bits: Column, other: Column) -> Column:
        half = F.floor(F.size(bits) / 2).cast("int")
        halves = F.zip_with(F.slice(bits, F.lit(1), half), F.slice(bits, half + 1, half), xor)
        return F.when(F.size(bits) > F.size(other), halves).otherwise(bits)

    apart = F.zip_with(folded(one, two), folded(two, one), lambda x, y: F.bit_count(xor(x, y)))
    return F.aggregate(apart, F.lit(0), lambda total, n: total + n)


def least_difference(one: bytes, two: bytes) -> int:
    """A lower bound of the symmetric difference of two sets, from their sketches."""
    x, y = np.frombuffer(one, np.uint8).astype(np.int64), np.frombuffer(two, np.uint8).astype(np.int64)
    if len(x) > len(y):
        x, y = y, x
    # Counters stop at 255, so a full one says nothing when it is added to another.
    if len(x) < len(y):
        if (y == 255).any() or (x == 255).any():
            return 0
        y = y.reshape(len(x), -1).sum(axis=1)
    return int(np.abs(x - y).sum())


_SCHEMA = pa.schema([
    ("kind", pa.string()), ("a", pa.int64()), ("b", pa.int64()), ("n", pa.int64()), ("m", pa.int64()),
    ("c", pa.int64()), ("id", pa.int64()), ("bucket", pa.int32()), ("hashes", pa.binary()), ("places", pa.binary()),
    ("bits", pa.list_(pa.int64())), ("short", pa.list_(pa.int64())),
])


def _crowds(keys: np.ndarray, ids: np.ndarray):
    """Sort by (signature, id), and find where each signature's group starts and how many it has."""
    order = np.lexsort((ids, keys))
    keys, ids = keys[order], ids[order]
    heads = np.ones(len(keys), bool)
    heads[1:] = keys[1:] != keys[:-1]
    at = np.flatnonzero(heads)
    return keys, ids, at, np.diff(np.append(at, len(keys)))


def _matches(keys, ids, at, counts, wide, buckets) -> Iterator[dict[str, list]]:
    """Pairs of each member with its group's first, and the members of the groups marked ``wide``."""
    group = np.repeat(np.arange(len(at)), counts)
    head = at[group]
    pair = np.arange(len(keys)) != head
    if pair.any():
        couples = np.unique(np.stack([ids[head][pair], ids[pair]], axis=1), axis=0)
        to = bucket_of(mix(couples[:, 1].astype(np.uint64)), buckets)
        yield {"kind": ["pair"] * len(couples), "a": couples[:, 0], "b": couples[:, 1], "bucket": to}
    crowd = wide[group]
    if crowd.any():
        to = bucket_of(mix(ids[crowd].astype(np.uint64)), buckets)
        yield {"kind": ["member"] * len(to), "a": keys[crowd].astype(np.int64), "id": ids[crowd], "bucket": to}


def _emit(size: int, percent: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A set's id in this job: the task, the flush and a short number within it.
        task, flushes = TaskContext.get().partitionId(), 0
        keys, held = [], 0
        seen: dict[int, int] = {}

        def flush():
            if not keys:
                return
            base = (task << 20 | flushes) << 16
            short = np.repeat(np.arange(len(keys)), [len(k) for k in keys])
            k, v, at, counts = _crowds(np.concatenate(keys), short)
            for found in _matches(k, v + base, at, counts, counts >= 2, buckets):
                yield _batch(found, _SCHEMA)
            # Only the first set of each signature goes on: a crowd is one entry per flush. A sign marks crowds.
            for many in (False, True):
                chosen = at[(counts >= 2) == many]
                for bucket, (h, n) in pack(k[chosen], [v[chosen].astype("<u2")], buckets):
                    row = {"kind": ["packed"], "bucket": [bucket], "hashes": [h], "places": [n], "id": [base], "c": [int(many)]}
                    yield _batch(row, _SCHEMA)
            keys.clear(), seen.clear()

        for batch in in_chunks(batches, "text", PART):
            docs = {"kind": [], "a": [], "b": [], "n": [], "m": [], "c": [], "id": [], "places": [], "bits": [], "short": []}
            if len(keys) + batch.num_rows > 1 << 16 or held > FLUSH_BYTES:
                yield from flush()
                flushes, held = flushes + 1, 0
            for doc_id, found in zip(batch.column("doc_id").to_pylist(), shingle_sets(batch.column("text"), size)):
                name, other = set_names(found)
                made, allowed = signatures(found, percent)
                at = None
                if len(found) and doc_id is not None:
                    if name not in seen:
                        seen[name] = len(keys)
                        keys.append(made)
                        held += 24 * len(made)
                    at = (task << 20 | flushes) << 16 | seen[name]
                bits = parity_bits(found)
                row = ("doc", name if len(found) else None, other, len(found), doc_id, allowed, at, sketch_of(found), bits, short_parities(bits))
                for column, value in zip(docs, row):
                    docs[column].append(value)
            docs["bucket"] = bucket_of(mix(np.array(docs["b"], np.int64).astype(np.uint64)), buckets)
            yield _batch(docs, _SCHEMA)
        yield from flush()

    return run


def _meet(buckets: int):
    def run(table: pa.Table) -> pa.Table:
        packed = table.filter(pc.equal(table["kind"], "packed"))
        out = [table.filter(pc.not_equal(table["kind"], "packed")).cast(_SCHEMA)]
        if packed.num_rows:
            keys = [np.frombuffer(x.as_buffer(), np.uint64) for x in packed["hashes"]]
            short = np.concatenate([np.frombuffer(x.as_buffer(), "<u2") for x in packed["places"]])
            sizes = [len(k) for k in keys]
            ids = np.repeat(packed["id"].to_numpy(), sizes) | short.astype(np.int64)
            # The mark of a crowd rides in the lowest bit.
            marked = np.repeat(packed["c"].to_numpy(), sizes)
            keys, ids, at, counts = _crowds(np.concatenate(keys), ids << 1 | marked)
            crowd = np.logical_or.reduceat(ids & 1 == 1, at)
            wide = (counts >= 3) | (counts == 2) & crowd
            out += [pa.Table.from_batches([_batch(x, _SCHEMA)]) for x in _matches(keys, ids >> 1, at, counts, wide, buckets)]
        return pa.concat_tables(out)

    return run


def _sets(size: int):
    schema = pa.schema([("name", pa.int64()), ("rep", pa.int64()), ("n", pa.int64()), ("shingles", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_chunks(batches, "text", PART):
            found = list(shingle_sets(batch.column("text"), size))
            names = [set_names(x)[0] for x in found]
            columns = [names, batch.column("doc_id"), [len(x) for x in found], [x.tobytes() for x in found]]
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, schema.types)], schema=schema)

    return run


def _may_reach(percent: int):
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = zip(*(batch.column(c).to_pylist() for c in ("n_a", "n_b", "left_sketch", "right_sketch")))
            keep = pa.array([least_difference(x, y) <= difference(n, m, percent) for n, m, x, y in sizes], pa.bool_())
            kept = batch.select(["a", "b"]).filter(keep)
            yield pa.RecordBatch.from_arrays(kept.columns, schema=schema)

    return run


def _compare(percent: int):
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            columns = [batch.column(c) for c in ("left_set", "right_set", "a", "b")]
            for left, right, a, b in zip(*columns):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (left, right))
                both = np.sort(np.concatenate([x, y]))
                common = int((both[1:] == both[:-1]).sum())
                if 100 * common >= percent * (len(x) + len(y) - common):
                    kept.append((a.as_py(), b.as_py()))
            yield pa.RecordBatch.from_arrays([pa.array([k[i] for k in kept], pa.int64()) for i in (0, 1)], schema=schema)

    return run


def verified(docs: DataFrame, pairs: DataFrame, classes: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """The pairs of set names that reach the similarity, as ``(a, b)`` of the sets' least doc_ids.

    Sizes and sketches, which are short, rule most other pairs out before sets are fetched and compared.
    """
    side = lambda end, sketch: classes.select(F.col("name").alias(end), F.col("n").alias(f"n_{end}"), F.col("sketch").alias(sketch))
    close = F.greatest("n_a", "n_b") * percent <= F.least("n_a", "n_b") * 100
    shown = pairs.join(side("a", "left_sketch"), "a").join(side("b", "right_sketch"), "b").where(close)
    pairs = stage(shown.mapInArrow(_may_reach(percent), "a long, b long"), "likely-pairs")
    names = pairs.select(F.col("a").alias("name")).unionAll(pairs.select("b")).distinct()
    wanted, count = staged_count(names.join(classes, "name").select("name", "rep"), "wanted-sets")
    ids = checked(wanted.select(F.col("rep").alias("doc_id")).distinct(), count, 16)
    with short_batches(docs.sparkSession):
        sets, rows = staged_count(docs.join(ids, "doc_id", "left_semi").mapInArrow(_sets(size), SETS), "sets")
    if rows > count:
        # Some doc_id has several rows: one row of each set goes on, so that equal rows meet nothing twice.
        sets = stage(sets.groupBy("name").agg(*[F.min(c).alias(c) for c in ("rep", "n", "shingles")]), "sets")
    left = pairs.join(sets.select(F.col("name").alias("a"), F.col("rep").alias("rep_a"), F.col("shingles").alias("left_set")), "a")
    right = sets.select(F.col("name").alias("b"), F.col("rep").alias("rep_b"), F.col("shingles").alias("right_set"))
    couples = left.join(right, "b").select(F.col("rep_a").alias("a"), F.col("rep_b").alias("b"), "left_set", "right_set")
    with short_batches(docs.sparkSession):
        return stage(couples.mapInArrow(_compare(percent), "a long, b long"), "links")


def _still_apart(members: DataFrame) -> DataFrame:
    """Members of the signatures whose sets are in different components, with the size of the crowd."""
    mixed = members.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y"), F.count("*").alias("crowd"))
    return members.join(mixed.where("x < y").select("key", "crowd"), "key")


def _to_compare(members: DataFrame) -> DataFrame:
    """Members that must still be compared with others of their signature.

    Similar sets of different components share more than ``allowed`` signatures that are still apart. So each set
    may leave out as many, the most crowded first in one order for all: the last shared one in that order is left
    out by neither.
    """
    order = Window.partitionBy("name").orderBy(F.desc("crowd"), "key")
    ranked = stage(_still_apart(members), "apart").withColumn("rank", F.row_number().over(order))
    return stage(_still_apart(ranked.where(F.col("rank") > F.col("allowed")).drop("rank", "crowd")), "apart")


def _with_earlier(members: DataFrame) -> DataFrame:
    """Members with up to ``EARLIER`` signatures of the same set that come before, by number.

    Two sets that have one of these in common meet there already. At the first signature they share they have none,
    so each pair is still met once, and seldom more often.
    """
    before = Window.partitionBy("name").orderBy("key").rowsBetween(-EARLIER, -1)
    return members.withColumn("earlier", F.collect_list("key").over(before))


def _may_link(one: str, two: str, percent: int) -> Column:
    """Whether sizes and parities of two sets allow a link.

    Short parities come first, as columns of numbers: most pairs end there, and make no arrays to be collected as garbage.
    """
    n, m = F.col(f"{one}n"), F.col(f"{two}n")
    reach = F.floor((n + m) * (100 - percent) / (100 + percent))
    odd = [F.bit_count(F.col(f"{one}short{i}").bitwiseXOR(F.col(f"{two}short{i}"))) for i in range(SHORT)]
    near = F.coalesce(sum(odd[1:], odd[0]) <= reach, F.lit(True))  # null where a set has no short parities
    return (F.greatest(n, m) * percent <= F.least(n, m) * 100) & near & (least_odd(F.col(f"{one}bits"), F.col(f"{two}bits")) <= reach)


def jaccard_components(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """``(doc_id, n_shingles, component_id)`` for every row of ``docs (doc_id, text)``.

    Two texts are linked when 100 * common shingles >= ``percent`` * all their shingles; the component is
    named by the least doc_id reachable. Texts of fewer than ``size`` words are one shingle; null and empty
    texts have none and stay alone. Rows with the same doc_id count as one document with several texts. A
    row without doc_id links nothing; it gets the component of its equals, or null. Other columns are ignored.
    ``percent`` must be at least 64, as the size bands link sets of neighbouring bands only.
    """
    if not LEAST_PERCENT <= percent <= 100:
        raise ValueError(f"percent must be from {LEAST_PERCENT} to 100, not {percent}")
    docs = only(docs, doc_id="long", text="string")
    buckets = bucket_count(docs)
    signed = docs.mapInArrow(_emit(size, percent, buckets), FOUND)
    with short_batches(docs.sparkSession):
        found = stage(dealt(signed, docs).applyInArrow(_meet(buckets), FOUND), "signatures")
    rows = found.where("kind = 'doc'").select(
        F.col("m").alias("doc_id"), "n", F.col("a").alias("name"), F.col("b").alias("other"),
        F.col("c").alias("allowed"), "id", F.col("places").alias("sketch"), "bits", "short",
    )
    facts = [F.first(c).alias(c) for c in ("n", "allowed", "sketch", "bits", "short")]
    classes = stage(rows.where("name is not null").groupBy("name", "other").agg(F.min("doc_id").alias("rep"), *facts), "classes")
    ids = stage(rows.where("id is not null").select("id", "name").distinct(), "ids")
    pairs = found.where("kind = 'pair'").select("a", "b")
    pairs = pairs.join(ids.select(F.col("id").alias("a"), F.col("name").alias("one")), "a")
    pairs = pairs.join(ids.select(F.col("id").alias("b"), F.col("name").alias("two")), "b").where("one <> two")
    pairs = pairs.select(F.least("one", "two").alias("a"), F.greatest("one", "two").alias("b"))
    pairs = stage(pairs.distinct(), "pairs")
    links = verified(docs, pairs, classes, size, percent)
    groups = components(links)

    named = classes.join(groups.withColumnRenamed("node", "rep"), "rep", "left")
    named = named.select("name", "n", "allowed", F.coalesce("component", "rep").alias("component"))
    members = found.where("kind = 'member'").select(F.col("a").alias("key"), "id").join(ids, "id")
    members = stage(members.select("key", "name").distinct(), "members").join(named, "name")

    # Sets of one signature that are still apart are compared with each other, where sizes and parities allow a link.
    short = [F.col("short")[i].alias(f"short{i}") for i in range(SHORT)]
    apart = _with_earlier(_to_compare(members)).join(classes.select("name", "bits", *short), "name")
    one, two = apart.alias("one"), apart.alias("two")
    other = (F.col("one.name") < F.col("two.name")) & (F.col("one.component") != F.col("two.component"))
    first = ~F.arrays_overlap("one.earlier", "two.earlier")
    met = one.join(two, (F.col("one.key") == F.col("two.key")) & other & _may_link("one.", "two.", percent) & first)
    more = met.select(F.col("one.name").alias("a"), F.col("two.name").alias("b")).distinct()
    more, count = staged_count(more.join(pairs, ["a", "b"], "left_anti"), "more-pairs")
    if count:
        links = links.unionAll(verified(docs, more, classes, size, percent))
        groups = components(links)

    named = classes.join(groups.withColumnRenamed("node", "rep"), "rep", "left")
    named = named.select("name", "other", F.coalesce("component", "rep").alias("component"))
    result = rows.where("name is not null").join(named, ["name", "other"]).select("doc_id", F.col("n").alias("n_shingles"), F.col("component").alias("component_id"))
    alone = rows.where("name is null").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return result.unionAll(alone)
