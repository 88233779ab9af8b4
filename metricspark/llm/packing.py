"""Packing documents into token sequences by patterns of lengths."""

from __future__ import annotations

import os
import re
import zlib
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from metricspark.session import durable

#: Tokens of a sequence, and the id that ends a document.
CAPACITY = 1024
END_ID = 2

#: Letters that every version of Unicode agrees on, and signs behind them.
_WORD = re.compile(r"( ?[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+)([^\w\s]*)")


def _byte_signs() -> dict[int, str]:
    """The sign each byte has in byte-level vocabularies: itself if it is visible in
    Latin-1, else the next one from U+0100 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in visible]
    return {b: chr(b) for b in visible} | {b: chr(0x100 + i) for i, b in enumerate(hidden)}


_BYTE_SIGNS = _byte_signs()

#: Cuts before a blank and around a line break are cuts of the tokenizer's own pre-tokens,
#: unless white space meets white space there.
_UNSAFE = re.compile(r"\s\s|\s\Z|\x00|<\|")
#: What is unsafe where blank and line break are the only white space, and the other kinds.
_UNSAFE_PLAIN = ("  ", " \n", "\n ", "\n\n", "\x00", "<|")
_RARE_SPACES = "".join(c for c in map(chr, range(0x3001)) if c.isspace() and c not in " \n")
#: Bits of a piece's rank among those of its length.
RANK_BITS = 48
#: Shares of the fitted repeat counts that are tried.
SHARES = (1.0, 0.9, 0.75, 0.5, 0.25)
#: Characters of the texts that are cut together.
GROUP_CHARS = 1 << 22
#: Parts whose ids a worker keeps before the older half goes, and the longest it keeps.
CACHE_PARTS = 1_000_000
LONGEST_PART = 64
_known: dict[str, "_Parts"] = {}


class _Parts(dict):
    """The ids of a text's parts as bytes, worked out where they are missing.

    Parts are kept in two halves. Once the newer one is full it becomes the older one, and what
    is asked for again moves on, so common parts stay and rare ones go.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenize = self.tokenizer.model.tokenize
        self.id_bytes = [n.to_bytes(4, "little") for n in range(self.tokenizer.get_vocab_size())]
        self.older: dict[str, bytes] = {}
        self.most: int | None = None

    def __missing__(self, part: str) -> bytes:
        if len(self) >= (self.most or CACHE_PARTS) // 2:
            self.older = dict(self)
            self.clear()
        ids = self.older.get(part)
        if ids is None:
            ids = self.learn(part)
        if len(part) <= LONGEST_PART:
            self[part] = ids
        return ids

    def learn(self, part: str) -> bytes:
        """A run of letters with its blank is one pre-token, so it goes straight to the
        vocabulary's merges; signs behind it are looked up alone. Everything else is encoded in
        full."""
        letters = part[1:] if part[:1] == " " else part
        if letters.isascii() and letters.isalpha():
            return self.merged(part if letters is part else _BYTE_SIGNS[0x20] + letters)
        found = _WORD.fullmatch(part)
        if found and found[2]:
            return self[found[1]] + self[found[2]]
        if found:
            return self.merged(part.encode().decode("latin-1").translate(_BYTE_SIGNS))
        return self.whole(part)

    def merged(self, signs: str) -> bytes:
        return b"".join([self.id_bytes[token.id] for token in self.tokenize(signs)])

    def whole(self, text: str) -> bytes:
        return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()


def _parts(path: str) -> _Parts:
    if path not in _known:
        _known[path] = _Parts(path)
    return _known[path]


def _unsafe(text: str) -> bool:
    if any(c in text for c in _RARE_SPACES):
        return _UNSAFE.search(text) is not None
    return any(c in text for c in _UNSAFE_PLAIN) or text[-1:] in (" ", "\n")


def token_bytes(texts: Sequence, path: str, keep_parts: int | None = None) -> Iterator[bytes]:
    """Ids of each text as little-endian unsigned 32-bit numbers, the end id included.

    The texts of a group are cut into parts and the different parts numbered, all in Arrow; only
    parts not met before go through the tokenizer. A text in which a part's ids could depend on
    its neighbours goes through it whole. The ids of ``keep_parts`` parts are kept, else of ``CACHE_PARTS``.
    """
    known, end = _parts(path), END_ID.to_bytes(4, "little")
    known.most = keep_parts
    at = 0
    while at < len(texts):
        group: list[str] = []
        size = 0
        while at < len(texts) and size < GROUP_CHARS:
            text = texts[at].as_py() if isinstance(texts, pa.Array) else texts[at]
            group.append(text or "")
            size += len(group[-1])
            at += 1
        unsafe = [_unsafe(text) for text in group]
        ids = _by_parts([text for text, whole in zip(group, unsafe) if not whole], known)
        for text, whole in zip(group, unsafe):
            yield (known.whole(text) if whole else next(ids)) + end


def _by_parts(texts: list[str], known: _Parts) -> Iterator[bytes]:
    """The ids of texts whose parts do not depend on each other."""
    marked = pc.replace_substring(pa.array(texts, pa.large_string()), " ", "\x00 ")
    parts = pc.split_pattern(pc.replace_substring(marked, "\n", "\x00\n\x00"), "\x00")
    coded = parts.flatten().dictionary_encode()
    number = coded.indices.to_numpy()
    ids = [known[part] for part in coded.dictionary.to_pylist()]
    lengths = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
    starts = np.concatenate([[0], np.cumsum(lengths)])
    held = pa.LargeListArray.from_arrays(pa.array(starts), pa.array(np.frombuffer(b"".join(ids), dtype="<u4")))
    flat = held.take(coded.indices).flatten().to_numpy().tobytes()
    ends = np.concatenate([[0], np.cumsum(lengths[number])])[parts.offsets.to_numpy()] * 4
    return (flat[a:b] for a, b in zip(ends, ends[1:]))


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` tokens: the first takes what is over."""
    first = n % capacity or capacity
    return [(0, first), *((at, capacity) for at in range(first, n, capacity))]


PIECES = (
    "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, ids binary, _chunk bigint, _rank bigint"
)


def tokenized_pieces(docs: DataFrame, path: str, capacity: int, keep_ids: bool, keep_parts: int | None = None) -> DataFrame:
    """The pieces of each document, ranked among the pieces of their length in their task.

    One narrow pass. The chunk number is the task's partition, so that ranks and chunks
    have to be stored before they are used.
    """
    schema = pa.schema(
        [("doc_id", pa.int64()), ("piece", pa.int32()), *((c, pa.int64()) for c in ("start", "length", "ids_crc32")),
         ("ids", pa.binary()), ("_chunk", pa.int64()), ("_rank", pa.int64())]
    )

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(capacity + 1, dtype=np.int64)
        for batch in batches:
            chunk = batch.column(2)[0].as_py() if batch.num_rows else 0
            rows: list[tuple] = []
            for doc_id, ids in zip(batch.column(0).to_pylist(), token_bytes(batch.column(1), path, keep_parts)):
                for piece, (start, length) in enumerate(cut(len(ids) // 4, capacity)):
                    own = ids[4 * start : 4 * (start + length)]
                    rows.append((doc_id, piece, start, length, zlib.crc32(own), own if keep_ids else None, chunk, int(seen[length])))
                    seen[length] += 1
            columns = list(zip(*rows)) or [()] * len(schema)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, schema.types)], schema=schema)

    slim = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text"), F.spark_partition_id().cast("bigint").alias("_chunk")
    )
    return slim.mapInArrow(pieces, PIECES)


# --- the plan, made from the histogram of lengths alone -------------------------------


def patterns(lengths: np.ndarray, capacity: int, thirds: int = 24) -> list[tuple[int, ...]]:
    """Patterns of at most four documents: whole multiples, pairs that fill a sequence, and
    for each length ``thirds`` triples (and their halved quadruples) that do.

    Where no present length fills the rest exactly, the largest that fits stands in.
    """
    present = np.sort(lengths)

    def largest(room: int) -> int:
        at = np.searchsorted(present, room, side="right")
        return int(present[at - 1]) if at else 0

    found: set[tuple[int, ...]] = set()
    for a in map(int, present):
        found.add((a,) * min(4, capacity // a))
        room = capacity - a
        if b := largest(room):
            found.add(tuple(sorted((a, b), reverse=True)))
        small = present[present <= room]
        for b in map(int, small[np.linspace(0, len(small) - 1, min(thirds, len(small))).astype(int)] if len(small) else ()):
            if c := largest(room - b):
                found.add(tuple(sorted((a, b, c), reverse=True)))
                if d := largest(room - b - c):
                    found.add(tuple(sorted((a, b, c, d), reverse=True)))
    return sorted(found, key=lambda p: (-sum(p), len(p), p))


def nonnegative_fit(columns: list[tuple[int, ...]], counts: np.ndarray, rounds: int = 300) -> np.ndarray:
    """x >= 0 that brings the summed patterns nearest to ``counts`` (least squares), by
    projected gradient steps with momentum on the sparse pattern matrix."""
    rows = np.concatenate([np.asarray(p) for p in columns])
    cols = np.repeat(np.arange(len(columns)), [len(p) for p in columns])
    size = len(counts)

    def apply(x: np.ndarray) -> np.ndarray:
        return np.bincount(rows, weights=x[cols], minlength=size)

    def transposed(r: np.ndarray) -> np.ndarray:
        return np.bincount(cols, weights=r[rows], minlength=len(columns))

    # A bound on the largest eigenvalue: largest row sum of A^T A.
    step = 1.0 / max(1.0, transposed(apply(np.ones(len(columns)))).max())
    x = np.zeros(len(columns))
    y, t = x, 1.0
    for _ in range(rounds):
        new = np.maximum(0.0, y - step * transposed(apply(y) - counts))
        t_new = (1 + (1 + 4 * t * t) ** 0.5) / 2
        y = new + (t - 1) / t_new * (new - x)
        x, t = new, t_new
    return x


def best_fit(counts: np.ndarray, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Best-fit decreasing over (length, count) groups: equal bins are filled together."""
    open_bins: dict[int, list[tuple[tuple[int, ...], int]]] = {}
    done: list[tuple[tuple[int, ...], int]] = []

    def keep(pattern: tuple[int, ...], n: int) -> None:
        room = capacity - sum(pattern)
        open_bins.setdefault(room, []).append((pattern, n)) if room else done.append((pattern, n))

    for length in range(len(counts) - 1, 0, -1):
        left = int(counts[length])
        while left:
            room = min((r for r in open_bins if r >= length), default=None)
            if room is None:
                each = capacity // length
                if left >= each:
                    keep((length,) * each, left // each)
                    left %= each
                else:
                    keep((length,) * left, 1)
                    left = 0
                continue
            pattern, n = open_bins[room].pop()
            if not open_bins[room]:
                del open_bins[room]
            used = min(n, left)
            if n > used:
                keep(pattern, n - used)
            keep((*pattern, length), used)
            left -= used
    return done + [group for groups in open_bins.values() for group in groups]


def plan(counts: np.ndarray, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """(pattern, sequences) that use each length exactly ``counts`` times.

    Repeat counts come from the non-negative fit, are rounded, and the residual is packed
    best-fit. Rounding down everywhere can use up short pieces that long ones need, so the
    fit is also rounded from SHARES of itself, and the plan of the fewest sequences is taken.
    The work depends on the number of lengths only, never on the number of documents.
    """
    lengths = np.flatnonzero(counts)
    candidates = [p for p in patterns(lengths, capacity) if sum(p) >= capacity - capacity // 256]
    if not candidates:
        return best_fit(counts.astype(np.int64), capacity)
    fit = nonnegative_fit(candidates, counts.astype(float))
    plans = [_rounded(candidates, fit * share, counts, capacity, up) for share in SHARES for up in (False, True)]
    return min(plans, key=lambda groups: sum(n for _, n in groups))


def _rounded(
    candidates: list[tuple[int, ...]], fit: np.ndarray, counts: np.ndarray, capacity: int, up: bool
) -> list[tuple[tuple[int, ...], int]]:
    """Patterns as often as ``fit`` says, rounded down, then with ``up`` once more where the
    histogram still has the lengths, those of the longest piece first; the residual best-fit."""
    left = counts.astype(np.int64).copy()
    whole = np.floor(fit + 1e-6)
    part = fit - whole
    tries = [(at, int(whole[at])) for at in np.argsort(-whole, kind="stable") if whole[at]]
    if up:
        tries += [(at, 1) for at in sorted(np.flatnonzero(part > 0.3), key=lambda at: (-candidates[at][0], -part[at]))]
    groups: list[tuple[tuple[int, ...], int]] = []
    for at, most in tries:
        need = Counter(candidates[at])
        n = min(most, *(int(left[k]) // v for k, v in need.items()))
        if n > 0:
            groups.append((candidates[at], n))
            for k, v in need.items():
                left[k] -= n * v
    return groups + best_fit(left, capacity)


def segments(groups: list[tuple[tuple[int, ...], int]]) -> np.ndarray:
    """Which ranks of a length go to which sequences: a row (length, first rank, first
    sequence, offset) per place in a pattern, sorted."""
    used: dict[int, int] = {}
    rows, base = [], 0
    for pattern, n in groups:
        offset = 0
        for length in pattern:
            first = used.get(length, 0)
            rows.append((length, first, base, offset))
            used[length] = first + n
            offset += length
        base += n
    return np.array(sorted(rows), dtype=np.int64).reshape(-1, 4)


def pack_documents(
    docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, keep_ids: bool = False, keep_parts: int | None = None
) -> DataFrame:
    """Cut documents into pieces of at most ``capacity`` tokens and place the pieces.

    Returns per piece doc_id, piece, start, length, ids_crc32, sequence_id and offset, and
    with ``keep_ids`` the ids as little-endian unsigned 32-bit numbers. A document's ids end
    with id 2, so a null or empty text is one piece of one token. Repeated rows are packed
    each on its own; other columns are not read; an empty table gives no rows. A Python worker
    keeps the ids of ``keep_parts`` parts of texts, as fewer take less memory and more time.

    Only the histogram of lengths, ``capacity`` numbers, reaches the driver. The pattern
    plan has a number of rows that depends on ``capacity`` alone, so it goes to the tasks
    with the function. The rank of a piece among those of its length is its rank in its
    task plus what earlier tasks have, so a hot length is never gathered.
    """
    pieces = durable(tokenized_pieces(docs, tokenizer, capacity, keep_ids, keep_parts), "pieces")
    per_chunk = pieces.groupBy("_chunk", "length").agg(F.count(F.lit(1)).alias("n"))
    histogram = per_chunk.groupBy("length").agg(F.sum("n").alias("n")).collect()  # at most `capacity` rows
    counts = np.zeros(capacity + 1, dtype=np.int64)
    for row in histogram:
        counts[row["length"]] = row["n"]
    lengths, firsts, bases, offsets = segments(plan(counts, capacity)).T
    key = (lengths << RANK_BITS) + firsts

    before = Window.partitionBy("length").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = per_chunk.select("_chunk", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_before"))
    ranked = pieces.join(starts, ["_chunk", "length"])
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if keep_ids else [])]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "_rank"))
            at = np.searchsorted(key, (length << RANK_BITS) + rank, side="right") - 1
            placed = [pa.array(bases[at] + rank - firsts[at]), pa.array(offsets[at])]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in columns), *placed], [*columns, "sequence_id", "offset"]
            )

    kinds = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, " + ("ids binary, " if keep_ids else "")
    ranked = ranked.select(*columns, (F.col("_rank") + F.col("_before")).alias("_rank"))
    return ranked.mapInArrow(place, kinds + "sequence_id bigint, offset bigint")
