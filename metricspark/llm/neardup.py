"""Near-duplicate groups by HyperMinHash: compressed registers, bands, estimates, exact sets."""

from __future__ import annotations

import hashlib
import zlib
from collections import OrderedDict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metricspark.llm.components import connected_components
from metricspark.llm.text import slices, space_words
from metricspark.session import durable


@dataclass(frozen=True)
class Sketch:
    """``bands`` bands of ``rows`` registers. A register holds the leading-zero count of its
    smallest hash, and the ``mantissa`` bits that follow the first one bit.

    With 42 bands of 6, a pair at a similarity of 0.8 shares no band in 3 of a million cases.
    """

    bands: int = 42
    rows: int = 6
    mantissa: int = 10

    @property
    def registers(self) -> int:
        return self.bands * self.rows


#: Links need 100 * intersection >= PERCENT * union.
PERCENT = 80
#: Candidates whose estimate is so many standard deviations below the bound are left out.
DEVIATIONS = 5.0
#: Rounds of filling a register without a hash from other registers before the set is scanned.
DENSIFY = 64


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser over an array (wraps around)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(words: list[bytes], size: int) -> set:
    """Distinct runs of ``size`` words; fewer words are one shingle; none give none."""
    if not words:
        return set()
    if len(words) < size:
        return {tuple(words)}
    return set(zip(*(words[i:] for i in range(size))))


def word_digest(words: list[bytes]) -> bytes:
    return hashlib.blake2b(b" ".join(words), digest_size=16).digest()


def text_digest(text: Column) -> Column:
    """The digest of a text's words; an empty one if it has none."""

    @F.arrow_udf("binary")
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            words = (space_words(text.as_py()) for text in batch)
            yield pa.array([word_digest(w) if w else b"" for w in words], pa.binary())

    # Else a filter pushed below would compute it a second time.
    return of.asNondeterministic()(text.cast("string"))


def raw_digest(text: Column) -> Column:
    """A digest of a text as it is, without Python; an empty one for null."""
    return F.coalesce(F.unhex(F.sha2(text.cast("string"), 256)), F.lit(b""))


def shingle_hashes(words: list[bytes], size: int) -> np.ndarray:
    """One 64-bit hash per run of words, repeats included. For sketches only: two words of
    one checksum may make two shingles look alike, which exact sets then tell apart."""
    if not words:
        return np.zeros(0, dtype=np.uint64)
    codes = _mix(np.fromiter(map(zlib.crc32, words), dtype=np.uint64, count=len(words)))
    n = max(1, len(codes) - size + 1)
    out = np.zeros(n, dtype=np.uint64)
    for i in range(min(size, len(codes))):
        out = _mix(out * np.uint64(0x9E3779B97F4A7C15) + codes[i : i + n])
    return out


def registers(hashes: np.ndarray, sketch: Sketch) -> np.ndarray:
    """Register values of a set: each hash goes to one register, which keeps the smallest.

    A register without a hash borrows from registers drawn by its own number, the same for
    every set, so that equal draws keep meaning equal minima in small sets.
    """
    m = sketch.registers
    place = ((hashes >> np.uint64(32)) * np.uint64(m) >> np.uint64(32)).astype(np.int64)
    value = _mix(hashes)
    low = np.full(m, np.iinfo(np.uint64).max, dtype=np.uint64)
    np.minimum.at(low, place, value)
    filled = np.zeros(m, dtype=bool)
    filled[place] = True
    if not filled.all():
        empty = np.flatnonzero(~filled)
        source = np.full(len(empty), -1)
        for attempt in range(1, DENSIFY + 1):
            open_ = np.flatnonzero(source < 0)
            if not len(open_):
                break
            drawn = (_mix(empty[open_].astype(np.uint64) * np.uint64(DENSIFY * 2) + np.uint64(attempt)) % np.uint64(m)).astype(np.int64)
            hit = filled[drawn]
            source[open_[hit]] = drawn[hit]
        # Very small sets: the filled register whose number is drawn lowest.
        for at in np.flatnonzero(source < 0):
            full = np.flatnonzero(filled).astype(np.uint64)
            source[at] = int(full[np.argmin(_mix(full * np.uint64(m) + np.uint64(empty[at]) + np.uint64(7)))])
        low[empty] = low[source]
    # Leading zeros by the exponent of a double, then the bits after the leading one.
    zeros = 63 - np.floor(np.log2(np.maximum(low, np.uint64(1)).astype(np.float64))).astype(np.int64)
    zeros = np.clip(zeros, 0, 63)
    shifted = low << np.minimum(zeros + 1, 63).astype(np.uint64)
    bits = (shifted >> np.uint64(64 - sketch.mantissa)).astype(np.int64)
    return ((zeros << sketch.mantissa) | bits).astype(np.uint16)


def chance_collisions(n: int, m: int, sketch: Sketch) -> float:
    """Share of registers expected to agree by chance in two disjoint sets of ``n`` and ``m``.

    Sums, over the cells of a register (leading zeros and mantissa), the product of the
    chances that the smaller hash of each set falls into the cell.
    """
    a, b = max(n, 1) / sketch.registers, max(m, 1) / sketch.registers
    cells = 1 << sketch.mantissa
    total = 0.0
    steps = np.arange(cells + 1) / cells
    for zeros in range(40):
        edges = 2.0 ** -(zeros + 1) * (1 + steps)
        pa_, pb_ = (np.exp(k * np.log1p(-np.minimum(edges, 1 - 1e-15))) for k in (a, b))
        total += float(((pa_[:-1] - pa_[1:]) * (pb_[:-1] - pb_[1:])).sum())
    return total


class Estimator:
    """Jaccard estimates from registers, corrected for chance collisions.

    The correction depends on the two set sizes; it is kept per power-of-two class of them.
    """

    def __init__(self, sketch: Sketch) -> None:
        self.sketch = sketch
        self.chance: dict[tuple[int, int], float] = {}

    def correction(self, n: int, m: int) -> float:
        key = (max(n, 1).bit_length(), max(m, 1).bit_length())
        if key not in self.chance:
            self.chance[key] = chance_collisions(1 << (key[0] - 1), 1 << (key[1] - 1), self.sketch)
        return self.chance[key]

    def __call__(self, a: np.ndarray, b: np.ndarray, n: int, m: int) -> float:
        chance = self.correction(n, m)
        return max(0.0, (float((a == b).mean()) - chance) / (1 - chance))

    def may_link(self, a: np.ndarray, b: np.ndarray, n: int, m: int) -> bool:
        """False only if sizes forbid a link or the estimate is far below the bound.

        Registers of a set smaller than their number repeat each other, so the deviation
        is that of as many draws as the smaller set has shingles.
        """
        j = PERCENT / 100
        if min(n, m) * 100 < PERCENT * max(n, m):
            return False
        draws = min(self.sketch.registers, n, m)
        return self(a, b, n, m) >= j - DEVIATIONS * (j * (1 - j) / draws) ** 0.5


SKETCHED = "doc_id bigint, n_shingles bigint, digest binary, registers binary, raw binary"


def sketches(docs: DataFrame, size: int, sketch: Sketch, with_raw: bool = False) -> DataFrame:
    """Exact set size, a digest of the normalised words, and the registers of every row;
    ``raw``, the digest of the text as it is, is null unless asked for."""

    schema = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), *((c, pa.binary()) for c in ("digest", "registers", "raw"))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, digests, made = [], [], []
            for text in batch.column(1):
                words = space_words(text.as_py())
                counts.append(len(shingles(words, size)))
                digests.append(word_digest(words) if words else None)
                made.append(registers(shingle_hashes(words, size), sketch).tobytes() if words else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(digests, pa.binary()), pa.array(made, pa.binary()), batch.column(2)],
                schema=schema,
            )

    raw = raw_digest(F.col("text")) if with_raw else F.lit(None).cast("binary")
    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"), raw.alias("raw")
    ).mapInArrow(run, SKETCHED)


def band_keys(distinct: DataFrame, sketch: Sketch) -> DataFrame:
    """(band key, node) for each band of each sketch; the key holds the band's number."""

    schema = pa.schema([("band", pa.int64()), ("node", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = _mix(np.arange(1, sketch.rows + 1, dtype=np.uint64))
        seeds = _mix(np.arange(1, sketch.bands + 1, dtype=np.uint64) << np.uint64(20))
        for batch in batches:
            if not batch.num_rows:
                continue
            held = np.frombuffer(b"".join(batch.column(1).to_pylist()), dtype=np.uint16).reshape(-1, sketch.bands, sketch.rows)
            mixed = _mix(held.astype(np.uint64) * weights + weights)
            keys = np.zeros(held.shape[:2], dtype=np.uint64)
            for r in range(sketch.rows):
                keys = _mix(keys * np.uint64(0x9E3779B97F4A7C15) + mixed[:, :, r] + seeds)
            ids = np.repeat(batch.column(0).to_numpy(zero_copy_only=False), sketch.bands)
            yield pa.RecordBatch.from_arrays([pa.array(keys.reshape(-1).view(np.int64)), pa.array(ids)], schema=schema)

    return distinct.select("node", "registers").mapInArrow(run, "band bigint, node bigint")


def verified(pairs: DataFrame, texts: DataFrame, size: int, sketch: Sketch) -> DataFrame:
    """The pairs (a, b) whose full shingle sets pass, after the estimate has ruled out most
    of the others. ``texts`` has node, n_shingles, registers and text of each class."""
    left = texts.select(*(F.col(c).alias(f"a_{c}") for c in ("node", "n_shingles", "registers")))
    right = texts.select(*(F.col(c).alias(f"b_{c}") for c in ("node", "n_shingles", "registers")))
    # Estimates need no texts, so those are fetched for the pairs that are left.
    rough = pairs.join(left, F.col("a") == F.col("a_node")).join(right, F.col("b") == F.col("b_node"))

    def estimate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        guess = Estimator(sketch)
        for batch in slices(batches, 4096):
            a, b, n, ra, m, rb = (batch.column(i).to_pylist() for i in range(6))
            keep = [
                guess.may_link(np.frombuffer(x, np.uint16), np.frombuffer(y, np.uint16), k, l)
                for x, y, k, l in zip(ra, rb, n, m)
            ]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    columns = ("a", "b", "a_n_shingles", "a_registers", "b_n_shingles", "b_registers")
    return confirmed(rough.select(*columns).mapInArrow(estimate, "a bigint, b bigint"), texts, size)


def confirmed(pairs: DataFrame, texts: DataFrame, size: int) -> DataFrame:
    """The pairs (a, b) whose full shingle sets pass."""
    one = texts.select(F.col("node").alias("a"), F.col("text").alias("a_text"))
    two = texts.select(F.col("node").alias("b"), F.col("text").alias("b_text"))
    both = pairs.join(one, "a").join(two, "b")

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        recent: OrderedDict[int, set] = OrderedDict()

        def of(node: int, text: str) -> set:
            held = recent.pop(node, None)
            recent[node] = held = shingles(space_words(text), size) if held is None else held
            if len(recent) > 64:
                recent.popitem(last=False)
            return held

        for batch in slices(batches):
            keep = []
            for a, b, x, y in zip(*(batch.column(i).to_pylist() for i in range(4))):
                one, two = of(a, x), of(b, y)
                both_ = len(one & two)
                keep.append(100 * both_ >= PERCENT * (len(one) + len(two) - both_))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return both.select("a", "b", "a_text", "b_text").mapInArrow(confirm, "a bigint, b bigint")


def near_duplicates(docs: DataFrame, size: int = 2, sketch: Sketch = Sketch(), by_text: bool = False) -> DataFrame:
    """Group documents whose sets of ``size``-word shingles overlap by 80 % or more.

    Returns per row of ``docs`` doc_id, n_shingles, component_id (the smallest doc_id
    reachable over links) and kept. Null, empty and blank texts have no shingles and stand
    alone; rows without a doc_id get a null component and are kept; rows that share a doc_id
    share a component. Other columns are not read. An empty table gives no rows.

    With ``by_text``, different texts under one doc_id are documents of their own: they are
    not tied, digest (see ``text_digest``) and raw (see ``raw_digest``) are returned too, and kept marks the rows of the
    smallest (doc_id, digest) of each group.

    1. One pass makes set size, digest and registers; equal word sequences fall together
       by an aggregation with map-side combine, so copies cost one row from here on.
    2. In each band, members are compared with a few pivots of their bucket, not with each
       other: estimates first, full sets then. The links give a first grouping.
    3. Buckets whose members are all in one group are settled. The members of the others
       go through an exact prefix filter, so no link between groups is lost, whatever the
       size of the bucket.
    """
    made = durable(sketches(docs, size, sketch, by_text), "sketches")
    sized = made.where("digest IS NOT NULL AND doc_id IS NOT NULL")
    grouped = sized.groupBy("digest").agg(
        F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n_shingles"), F.first("registers").alias("registers")
    )
    # Numbers that stand for the texts; any numbers will do once they are stored.
    classes = durable(grouped.withColumn("node", F.monotonically_increasing_id()), "distinct")
    numbers = classes.select(F.col("digest").alias("_digest"), "node")
    keys = durable(_crowded(band_keys(classes, sketch)), "bands")
    texts = _texts(docs, classes, keys)

    links = durable(verified(_to_pivots(keys), texts, size, sketch), "links")
    rest = _open_nodes(keys, connected_components(links, rounds=2))
    more = durable(confirmed(_between_groups(rest, texts, size), texts, size), "links")

    if by_text:
        return _kept_texts(made, classes, connected_components(links.unionByName(more)))
    # Different texts under one doc_id are one document with several rows.
    own = sized.select("doc_id", "digest").distinct().join(numbers, F.col("digest") == F.col("_digest"))
    shared = own.groupBy("doc_id").agg(F.min("node").alias("a"), F.max("node").alias("_b")).where("a <> _b").drop("_b")
    tied = own.join(shared, "doc_id").select("a", F.col("node").alias("b"))
    groups = connected_components(links.unionByName(more).unionByName(tied))

    placed = classes.join(groups.withColumnRenamed("node", "_node"), F.col("node") == F.col("_node"), "left").select(
        F.col("digest").alias("_digest"), "doc_id", F.coalesce("component", "node").alias("component")
    )
    smallest = placed.groupBy(F.col("component").alias("_component")).agg(F.min("doc_id").alias("_low"))
    placed = placed.join(smallest, F.col("component") == F.col("_component")).select("_digest", "_low")
    rows = made.select("doc_id", "n_shingles", "digest").join(placed, F.col("digest") == F.col("_digest"), "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("_low", "doc_id"))
    return rows.select(
        "doc_id", "n_shingles", component.alias("component_id"), F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept")
    )


def _kept_texts(made: DataFrame, classes: DataFrame, groups: DataFrame) -> DataFrame:
    """The rows of ``near_duplicates`` by text: each class is in one group of linked classes."""
    placed = classes.join(groups.withColumnRenamed("node", "_node"), F.col("node") == F.col("_node"), "left").select(
        F.col("digest").alias("_digest"), "doc_id", F.coalesce("component", "node").alias("component")
    )
    first = F.min(F.struct("doc_id", "_digest")).alias("_first")
    smallest = placed.groupBy(F.col("component").alias("_component")).agg(first)
    placed = placed.join(smallest, F.col("component") == F.col("_component")).select("_digest", "_first")
    rows = made.select("doc_id", "n_shingles", "digest", "raw").join(placed, F.col("digest") == F.col("_digest"), "left")
    known = F.col("doc_id").isNotNull()
    kept = F.coalesce(F.struct("doc_id", "digest") == F.struct("_first.doc_id", "_first._digest"), F.lit(True))
    return rows.select(
        "doc_id", "n_shingles", F.coalesce("digest", F.lit(b"")).alias("digest"), "raw",
        F.when(known, F.coalesce("_first.doc_id", "doc_id")).alias("component_id"),
        (~known | F.col("_first").isNull() | kept).alias("kept"),
    )


def _crowded(keys: DataFrame) -> DataFrame:
    """The band keys that more than one document has."""
    shared = keys.groupBy("band").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("band")
    return keys.join(shared, "band", "left_semi")


def _texts(docs: DataFrame, classes: DataFrame, keys: DataFrame) -> DataFrame:
    """Text, size and registers of the classes that share a band."""
    met = keys.select("node").distinct()
    slim = classes.join(met, "node", "left_semi").withColumnsRenamed({"doc_id": "_id", "digest": "_digest"})
    texts = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"), text_digest(F.col("text")).alias("digest")
    )
    # By both, so that many texts under one doc_id do not all meet.
    found = texts.join(slim, (F.col("doc_id") == F.col("_id")) & (F.col("digest") == F.col("_digest")))
    found = found.select("node", "n_shingles", "registers", "digest", "text")

    # Rows of one doc_id and the same words come once.
    return durable(found.dropDuplicates(["node"]), "met-texts")


def _to_pivots(keys: DataFrame) -> DataFrame:
    """Pairs of each member of a bucket with the bucket's two pivots: its smallest node, and
    one drawn by a hash anew in each bucket."""
    pivots = keys.groupBy("band").agg(F.min("node").alias("low"), F.max_by("node", F.xxhash64("node", "band")).alias("any"))
    met = keys.join(pivots, "band").select("node", F.explode(F.array("low", "any")).alias("pivot")).where("node <> pivot")
    return met.select(F.least("node", "pivot").alias("a"), F.greatest("node", "pivot").alias("b")).distinct()


def _open_nodes(keys: DataFrame, groups: DataFrame) -> DataFrame:
    """(band, node, group, size) of the buckets whose members are in more than one group so
    far, with the size of the member's group in the whole corpus."""
    sizes = groups.groupBy(F.col("component").alias("_component")).agg(F.count(F.lit(1)).alias("_size"))
    sized = groups.join(sizes, F.col("component") == F.col("_component")).select(F.col("node").alias("_node"), "component", "_size")
    named = keys.join(sized, F.col("node") == F.col("_node"), "left").select(
        "band", "node", F.coalesce("component", "node").alias("group"), F.coalesce("_size", F.lit(1)).alias("size")
    )
    return durable(named.join(_divided(named, "band"), "band"), "buckets")


def _divided(members: DataFrame, key: str) -> DataFrame:
    """(key, main) for each key with members of several groups; main is the largest group."""
    split = members.groupBy(key).agg(
        F.min("group").alias("_low"), F.max("group").alias("_high"), F.max_by("group", F.struct("size", "group")).alias("main")
    )
    return split.where("_low <> _high").select(key, "main")


def _between_groups(members: DataFrame, texts: DataFrame, size: int) -> DataFrame:
    """Pairs in different groups that can still be linked, among the members of open buckets.

    Exact, by the prefix filter: in one order of all shingles, the rarest first, two sets
    that reach the bound share a shingle among the first |x| - ceil(0.8 |x|) + 1 of each.
    Copies that were edited beyond the bound begin with shingles of their own, so they meet
    nobody, however large their bucket is; what is left of two sets from a shared shingle on
    must still reach the bound. A shingle whose documents are all in one group is
    settled; in the others, members outside the main group meet the rest.
    """
    nodes = members.select("node", "group", "size").distinct()
    held = texts.select(F.col("node").alias("_node"), "text").join(nodes, F.col("node") == F.col("_node"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            hashes = [
                np.unique(np.fromiter((xxhash.xxh3_64_intdigest(b"\n".join(s)) for s in shingles(space_words(t.as_py()), size)), np.uint64))
                for t in batch.column(3)
            ]
            at = np.repeat(np.arange(batch.num_rows), [len(h) for h in hashes])
            token = np.concatenate(hashes).view(np.int64) if hashes else np.zeros(0, dtype=np.int64)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i).take(pa.array(at)) for i in range(3)), pa.array(token)], ["node", "group", "size", "token"]
            )

    fields = "node bigint, group bigint, size bigint, token bigint"
    tokens = durable(held.select("node", "group", "size", "text").mapInArrow(cut, fields), "shingles")
    often = tokens.groupBy(F.col("token").alias("_token")).agg(F.count(F.lit(1)).alias("n"))
    ranked = tokens.join(often, F.col("token") == F.col("_token")).groupBy("node", "group", "size").agg(
        F.sort_array(F.collect_list(F.struct("n", "token"))).alias("all")
    )
    n = F.size("all")
    prefix = F.slice("all", F.lit(1), n - F.ceil(n * PERCENT / 100).cast("int") + 1)
    firsts = ranked.select("node", "group", "size", n.alias("n"), F.posexplode(prefix).alias("at", "t")).where("t.n > 1")
    firsts = durable(firsts.select("node", "group", "size", "t.token", (F.col("n") - F.col("at")).alias("left"), "n"), "prefixes")
    live = firsts.join(_divided(firsts, "token"), "token")
    one, two = (
        live.where(rows).select("token", *(F.col(c).alias(f"{side}_{c}") for c in ("node", "group", "left", "n")))
        for side, rows in (("x", "group <> main"), ("y", "true"))
    )
    # The first shingle two sets share leaves room for no more than the shorter rest.
    possible = F.least("x_left", "y_left") * (100 + PERCENT) >= (F.col("x_n") + F.col("y_n")) * PERCENT
    met = one.join(two, "token").where((F.col("x_group") != F.col("y_group")) & possible)
    return met.select(F.least("x_node", "y_node").alias("a"), F.greatest("x_node", "y_node").alias("b")).distinct()
