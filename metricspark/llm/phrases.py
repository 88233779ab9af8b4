"""Phrases whose words keep together, mined level by level over stored occurrence relations.

The relation of level k holds, for each position of each piece, the phrase of k words that
begins there. It is stored sorted by piece and position, some pieces to a chunk (a row), so that
the merge-join with the relation of single words, on equal piece and position k further on,
reads both sides in order inside the chunk. For the group count a chunk sends each of its
different phrases once, with its count; for the semi-join it gets back which are frequent.
Words travel as rows. Longer phrases are so many that they travel sorted, in one blob for each
chunk and slot, where a slot takes the phrases of one range of a hash.
"""

from __future__ import annotations

import string
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metricspark.llm.text import shuffles_removed, slices
from metricspark.operators.ids import assign_ids
from metricspark.session import durable

MIN_COUNT = 10
MAX_WORDS = 3
TOP = 2000
#: Share, in hundredths, of a candidate's count from which a longer one takes its place.
ABSORB = 50
SCALE = 1_000_000
#: Words after which a chunk is closed; its last text may run over.
CHUNK_WORDS = 1 << 19
#: Words of the corpus for each slot, so about the most entries that a slot adds up.
SLOT_WORDS = 1 << 21
#: The code of a position that ends a piece or holds an infrequent word or phrase.
NONE = -1
NO_LANG = "und"

#: A-Z in small letters, a line feed for what ends a piece, a blank for a tab.
_PIECE_BYTES = bytes(
    0x0A if chr(b) in ".,;:!?\n\v\f\r" else 0x20 if b == 0x09 else b | 0x20 if chr(b) in string.ascii_uppercase else b
    for b in range(256)
)


def _pieces(text: bytes | None) -> list[list[bytes]]:
    return [p.split() for p in text.translate(_PIECE_BYTES).split(b"\n")] if text else []


def _shut(*arrays: np.ndarray) -> bytes:
    """Whole numbers of four or eight bytes, byte plane by byte plane, compressed."""
    planes = b"".join(np.ascontiguousarray(a).view(np.uint8).reshape(-1, a.itemsize).T.tobytes() for a in arrays)
    return pa.compress(planes, "zstd", asbytes=True) if planes else b""


def _open(shut: bytes, n: int, *types: type) -> list[np.ndarray]:
    """The arrays of ``n`` numbers of the given types that went into :func:`_shut`."""
    if not n:
        return [np.empty(0, t) for t in types]
    widths = [np.dtype(t).itemsize for t in types]
    planes = np.frombuffer(pa.decompress(shut, n * sum(widths), "zstd"), np.uint8)
    ends = np.cumsum([0, *widths]) * n
    return [
        np.ascontiguousarray(planes[at:to].reshape(w, n).T).view(t).ravel() for at, to, w, t in zip(ends, ends[1:], widths, types)
    ]


# --- the relation of single words -----------------------------------------------------
#
# A stored level has two kinds of rows: one per chunk with its occurrences as blobs, and one
# per chunk and different word or phrase with its code there and how often it occurs.

_WORDS = pa.schema(
    [("chunk", pa.int64()), ("size", pa.int64()), ("codes", pa.binary()),
     ("code", pa.int32()), ("lang", pa.string()), ("word", pa.string()), ("n", pa.int64())]
)
_WORDS_SQL = "chunk bigint, size bigint, codes binary, code int, lang string, word string, n bigint"


def _stacked(schema: pa.Schema, chunk: int, blobs: dict, rows: dict) -> pa.Table:
    """The chunk's row of ``blobs`` and its ``rows``, each with nulls for the other's columns."""
    head = {c: [v] for c, v in blobs.items()} | {"chunk": [chunk]}
    tail = rows | {"chunk": np.full(len(next(iter(rows.values()))), chunk)}
    return pa.concat_tables([_filled(schema, head), _filled(schema, tail)])


def word_occurrences(docs: DataFrame, chunk_words: int = CHUNK_WORDS) -> DataFrame:
    """Level 1: per chunk the code of the word at each position, NONE behind each piece, and
    the lang, text and count of each code. To be stored before use, as chunks are numbered by
    task."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, codes, code_of = 0, [], {}
        fresh = count()
        for batch in slices(batches):
            for lang, text, part in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()), batch.column(2)):
                known = code_of.setdefault(lang, defaultdict(fresh.__next__))
                for words in _pieces(text.as_py()):
                    if words:
                        codes.extend(map(known.__getitem__, words))
                        codes.append(NONE)
                if len(codes) >= chunk_words:
                    yield from close((part.as_py() << 33) + number, codes, code_of)
                    number, codes, code_of = number + 1, [], {}
                    fresh = count()
        if codes:
            yield from close((part.as_py() << 33) + number, codes, code_of)

    def close(chunk: int, codes: list[int], code_of: dict) -> list[pa.RecordBatch]:
        held = np.array(codes, dtype=np.int32)
        counts = np.bincount(held[held >= 0])
        out = []
        for at, (lang, known) in enumerate(code_of.items()):
            own = np.fromiter(known.values(), np.int32, len(known))
            rows = {"code": own, "lang": [lang] * len(own), "word": pa.array(list(known), pa.binary()).cast(pa.string()), "n": counts[own]}
            out += _stacked(_WORDS, chunk, {"size": len(held), "codes": _shut(held)}, rows).slice(min(at, 1)).to_batches()
        return out

    plain = docs.select(
        F.coalesce("lang", F.lit(NO_LANG)).alias("lang"), F.col("text"), F.spark_partition_id().cast("bigint").alias("part")
    )
    return plain.mapInArrow(read, _WORDS_SQL)


# --- the relations of longer phrases --------------------------------------------------

_GRAMS = pa.schema(
    [("chunk", pa.int64()), ("size", pa.int64()), ("codes", pa.binary()), ("ids", pa.binary()), ("grams", pa.binary()),
     ("slot", pa.int64()), ("n", pa.int64()), ("phrases", pa.binary())]
)
_GRAMS_SQL = "chunk bigint, size bigint, codes binary, ids binary, grams binary, slot bigint, n bigint, phrases binary"
_OCCURRENCES = ("chunk", "size", "codes", "ids", "grams")
_COUNTED = pa.schema(
    [("id", pa.int64()), ("head", pa.int64()), ("last", pa.int64()), ("f", pa.int64()),
     ("chunk", pa.int64()), ("slot", pa.int64()), ("n", pa.int64()), ("ranks", pa.binary())]
)
_COUNTED_SQL = "id bigint, head bigint, last bigint, f bigint, chunk bigint, slot bigint, n bigint, ranks binary"
#: Odd factors of the hash that deals phrases to slots.
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))


def _first(table: pa.Table, name: str):
    return table.column(name)[0].as_py()


def _only(codes: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """The codes that have an id, NONE for the others: the semi-join's left side."""
    return np.where((codes >= 0) & (ids[codes] >= 0), codes, np.int32(NONE)).astype(np.int32) if len(ids) else codes


def _merge_join(
    chunk: int, codes: np.ndarray, ids: np.ndarray, grams: np.ndarray, gram_ids: np.ndarray, k: int, slots: int, last: bool
) -> pa.Table:
    """Join phrases of ``k`` words with the words ``k`` positions on, both in order of position,
    number the different phrases of ``k + 1`` words by slot, head and last word, and count them.
    The occurrences are kept unless this is the ``last`` level.

    Code NONE ends a piece, so a phrase and the word behind it are in one piece."""
    start = np.flatnonzero((grams[: max(0, len(grams) - k)] >= 0) & (codes[k:] >= 0))
    pairs = grams[start].astype(np.int64) * len(ids) + codes[start + k]
    found, group, counts = np.unique(pairs, return_inverse=True, return_counts=True)
    width = max(1, len(ids))
    heads, lasts = gram_ids[found // width], ids[found % width]
    mixed = (heads.astype(np.uint64) * _MIX[0]) ^ (lasts.astype(np.uint64) * _MIX[1])
    slot = ((mixed >> np.uint64(32)) % np.uint64(slots)).astype(np.int64)
    order = np.lexsort((lasts, heads, slot))
    number = np.empty(len(order), dtype=np.int32)
    number[order] = np.arange(len(order), dtype=np.int32)
    longer = np.full(len(codes), NONE, dtype=np.int32)
    longer[start] = number[group]
    heads, lasts, slot, counts = heads[order], lasts[order], slot[order], counts[order]
    ends = np.flatnonzero(np.diff(slot, prepend=NONE, append=slots))
    blobs = [
        _shut(np.diff(heads[at:to], prepend=0), lasts[at:to], counts[at:to].astype(np.int64)) for at, to in zip(ends, ends[1:])
    ]
    rows = {"slot": slot[ends[:-1]], "n": np.diff(ends), "phrases": blobs}
    kept = {} if last else {"size": len(codes), "codes": _shut(codes), "ids": _shut(ids), "grams": _shut(longer)}
    return _stacked(_GRAMS, chunk, kept, rows)


def _second_level(slots: int, last: bool):
    def extend(left: pa.Table, right: pa.Table) -> pa.Table:
        (codes,) = _open(_first(left, "codes"), _first(left, "size"), np.int32)
        ids = np.full(int(codes.max(initial=NONE)) + 1, NONE, dtype=np.int64)
        ids[right.column("code").to_numpy()] = right.column("id").to_numpy()
        codes = _only(codes, ids)
        ids = ids[: int(codes.max(initial=NONE)) + 1]
        return _merge_join(_first(left, "chunk"), codes, ids, codes, ids, 1, slots, last)

    return extend


def _further_level(k: int, slots: int, last: bool):
    def extend(left: pa.Table, right: pa.Table) -> pa.Table:
        size = _first(left, "size")
        (codes,), (grams,) = (_open(_first(left, c), size, np.int32) for c in ("codes", "grams"))
        (ids,) = _open(_first(left, "ids"), int(codes.max(initial=NONE)) + 1, np.int64)
        held = sorted(zip(*(right.column(c).to_pylist() for c in ("slot", "n", "ranks"))))
        gram_ids = [np.empty(0, np.int64)]
        for slot, n, ranks in held:  # in the order the chunk numbered its phrases
            (rank,) = _open(ranks, n, np.int32)
            gram_ids.append(np.where(rank >= 0, rank.astype(np.int64) * slots + slot, NONE))
        gram_ids = np.concatenate(gram_ids)
        return _merge_join(_first(left, "chunk"), codes, ids, _only(grams, gram_ids), gram_ids, k, slots, last)

    return extend


def _count_slot(min_count: int, slots: int, last: bool):
    """Add up the counts of a slot's phrases over all chunks; a frequent phrase gets its rank
    times ``slots`` plus the slot as id, and each chunk, unless the level is the ``last``, the
    ranks of its own, NONE for the rest."""

    def add_up(table: pa.Table) -> pa.Table:
        slot, sizes = _first(table, "slot"), table.column("n").to_pylist()
        parts = [_open(b, n, np.int64, np.int64, np.int64) for b, n in zip(table.column("phrases").to_pylist(), sizes)]
        heads = np.concatenate([np.cumsum(h) for h, _, _ in parts])
        lasts, counts = (np.concatenate([p[c] for p in parts]) for c in (1, 2))
        order = np.lexsort((lasts, heads))
        heads, lasts = heads[order], lasts[order]
        opens = np.append(True, (np.diff(heads) != 0) | (np.diff(lasts) != 0))
        at = np.flatnonzero(opens)
        f = np.add.reduceat(counts[order], at)
        frequent = f >= min_count
        rank = np.where(frequent, np.cumsum(frequent) - 1, NONE).astype(np.int32)
        own = np.empty(len(order), dtype=np.int32)
        own[order] = rank[np.cumsum(opens) - 1]
        held = at[frequent]
        found = {"id": np.arange(len(held)) * slots + slot, "head": heads[held], "last": lasts[held], "f": f[frequent]}
        if last:
            return _filled(_COUNTED, found)
        replies = {
            "chunk": table.column("chunk"), "slot": table.column("slot"), "n": table.column("n"),
            "ranks": [_shut(r) for r in np.split(own, np.cumsum(sizes)[:-1])],
        }
        return pa.concat_tables([_filled(_COUNTED, found), _filled(_COUNTED, replies)])

    return add_up


def _filled(schema: pa.Schema, columns: dict) -> pa.Table:
    """The columns, with nulls for those the schema has besides."""
    n = len(next(iter(columns.values())))
    given = lambda c: columns[c.name].combine_chunks() if isinstance(columns[c.name], pa.ChunkedArray) else pa.array(columns[c.name], c.type)
    return pa.Table.from_arrays([given(c) if c.name in columns else pa.nulls(n, c.type) for c in schema], schema=schema)


def _extended(level: DataFrame, frequent: DataFrame, step) -> DataFrame:
    """The next level from a level and what its chunks know of their frequent groups."""
    left = level.where("codes IS NOT NULL").select(*(c for c in level.columns if c in _OCCURRENCES))
    mine = frequent.withColumnRenamed("chunk", "of_chunk").groupBy("of_chunk")
    return left.groupBy("chunk").cogroup(mine).applyInArrow(step, _GRAMS_SQL)


def _counted(level: DataFrame, min_count: int, slots: int, last: bool) -> DataFrame:
    sent = level.where("slot IS NOT NULL").select("slot", "chunk", "n", "phrases")
    return sent.groupBy("slot").applyInArrow(_count_slot(min_count, slots, last), _COUNTED_SQL)


# --- from groups to phrases -----------------------------------------------------------


def _cuts(phrases: DataFrame, parts: DataFrame) -> DataFrame:
    """``ids, a, l, r, score``: each phrase at its lowest-scoring cut, the first of equal ones.

    Products of three counts are decimals of 38 digits, exact for counts below 10**15, and
    ``div`` floors them without rounding."""
    at = phrases.select("ids", "a", F.explode(F.sequence(F.lit(1), F.size("ids") - 1)).alias("k"))
    cut = at.select("*", F.slice("ids", F.lit(1), F.col("k")).alias("left"), F.expr("slice(ids, k + 1, size(ids))").alias("right"))
    known = cut.join(parts.select(F.col("ids").alias("left"), F.col("f").alias("l")), "left").join(
        parts.select(F.col("ids").alias("right"), F.col("f").alias("r")), "right"
    )
    wide = lambda c: F.col(c).cast("decimal(19,0)")
    score = F.call_function("div", wide("a") * wide("a") * F.lit(SCALE).cast("decimal(7,0)"), wide("l") * wide("r"))
    scored = known.withColumn("score", score.cast("bigint"))
    least = scored.groupBy("ids", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("m"))
    return least.select("ids", "a", "m.l", "m.r", "m.score")


def _absorbed(phrases: DataFrame, absorb: int) -> DataFrame:
    """The phrases inside a longer one that holds enough of their occurrences."""
    inner = F.expr(
        "flatten(transform(sequence(2, size(ids) - 1), n -> transform(sequence(1, size(ids) - n + 1), p -> slice(ids, p, n))))"
    )
    longer = phrases.where(F.size("ids") > 2).select(F.col("a").alias("longer"), F.explode(F.array_distinct(inner)).alias("ids"))
    most = longer.groupBy("ids").agg(F.max("longer").alias("longer"))
    return phrases.join(most, "ids").where(100 * F.col("longer") >= absorb * F.col("a")).select("ids")


def mine_phrases(
    docs: DataFrame, min_count: int = MIN_COUNT, max_words: int = MAX_WORDS, top: int = TOP, absorb: int = ABSORB,
    chunk_words: int = CHUNK_WORDS,
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the phrases of each language that hold together
    best.

    Null text is empty, null lang is ``und``; each row counts, repeated or not; texts without
    words add nothing and an empty table gives no rows. A phrase is cut where its score
    ``floor(SCALE * a * a / (l * r))`` is the lowest. Ties of rank go to the greater count, then
    to the smaller phrase. Other columns are not read.

    A chunk takes whole texts, so the memory of a task is that of ``chunk_words`` words and the
    longest text, or of a slot: there are as many slots as the corpus has ``SLOT_WORDS`` words.
    A word or phrase that is a third of all rows is one row or entry per chunk wherever it is
    counted.
    """
    with shuffles_removed(docs.sparkSession):
        level = durable(word_occurrences(docs, chunk_words), "words-1")
        held = level.where("code IS NOT NULL").drop("size", "codes")
        words = durable(held.groupBy("lang", "word").agg(F.sum("n").alias("f")), "word-counts")
        totals = durable(words.groupBy("lang").agg(F.sum("f").alias("n")), "totals")
        slots = 1 + (totals.agg(F.sum("n")).first()[0] or 0) // SLOT_WORDS
        frequent = words.where(F.col("f") >= min_count)
        dictionary = durable(assign_ids(frequent, ["lang", "word"], "id", "bigint"), "dictionary")
        known = held.drop("n").join(dictionary.select("lang", "word", "id"), ["lang", "word"]).select("chunk", "code", "id")
        groups = dictionary.select("id", F.array("id").alias("ids"), "f")
        parts, step = [groups], _second_level(slots, max_words == 2)
        for k in range(2, max_words + 1):
            level = durable(_extended(level, known, step), f"phrases-{k}")
            counted = durable(_counted(level, min_count, slots, k == max_words), f"counted-{k}")
            named = counted.where("id IS NOT NULL").join(groups.select(F.col("id").alias("head"), F.col("ids").alias("before")), "head")
            groups = durable(named.select("id", F.concat("before", F.array("last")).alias("ids"), "f"), f"groups-{k}")
            known = counted.where("chunk IS NOT NULL").select("chunk", "slot", "n", "ranks")
            parts.append(groups)
            step = _further_level(k, slots, k + 1 == max_words)
        every = parts[0]
        for more in parts[1:]:
            every = every.unionByName(more)
        phrases = every.where(F.size("ids") > 1).select("ids", F.col("f").alias("a"))
        scored = durable(_cuts(phrases, every).join(_absorbed(phrases, absorb), "ids", "left_anti"), "scored")
        spelled = (
            scored.select("ids", F.posexplode("ids").alias("at", "id")).join(dictionary.drop("f"), "id").groupBy("ids")
            .agg(F.first("lang").alias("lang"), F.sort_array(F.collect_list(F.struct("at", "word"))).alias("w"))
            .select("ids", "lang", F.array_join(F.col("w.word"), " ").alias("phrase"))
        )
        named = scored.join(spelled, "ids").select(
            "lang", (-F.col("score")).alias("down_score"), (-F.col("a")).alias("down_a"), "phrase", "l", "r"
        )
        ranked = assign_ids(durable(named, "named"), ["lang", "down_score", "down_a", "phrase"], "at", "bigint")
        firsts = ranked.groupBy("lang").agg(F.min("at").alias("first"))
        rank = F.col("at") - F.col("first") + 1
        best = ranked.join(firsts, "lang").where(rank <= top).join(totals, "lang")
        return best.select(
            "lang", rank.alias("rank"), "phrase", (-F.col("down_a")).alias("a"), "l", "r", "n", (-F.col("down_score")).alias("score")
        )
