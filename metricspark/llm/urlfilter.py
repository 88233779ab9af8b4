"""URL rules as one bit-parallel automaton: all globs are simulated together, Shift-And style."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from metricspark.llm.text import ascii_lower

#: Words of state that are held at once: rows of a slice times words of a row.
STATE_WORDS = 1 << 20
_ONE = np.uint64(1)
_TOP = np.uint64(63)


@dataclass(frozen=True)
class Rule:
    """A glob over the canonical URL, the text it is reported by, and its verdict.

    The canonical URL is a dot, the host in small letters, and the path. ``*`` stands for any
    run of bytes without ``/``, ``**`` for any run, ``?`` for one byte other than ``/``, and a
    backslash takes what follows as it is. A glob matches the whole canonical URL.
    """

    text: str
    glob: str
    verdict: str


def host_rule(host: str, path: str, verdict: str) -> Rule:
    """A rule on a host, its subdomains, and the paths that start with ``path``."""
    plain = "".join("\\" + c if c in "\\*?" else c for c in host + path)
    return Rule(host + path, f"*.{plain}**", verdict)


def _elements(glob: str) -> list[bytes | str]:
    """Single bytes, and the wildcards ``?``, ``*`` and ``**``."""
    out: list[bytes | str] = []
    at = 0
    while at < len(glob):
        if glob[at] == "*":
            stars = 2 if glob[at : at + 2] == "**" else 1
            out.append("*" * stars)
            at += stars
            continue
        if glob[at] == "?":
            out.append("?")
        else:
            at += glob[at] == "\\" and at + 1 < len(glob)
            out += [bytes([b]) for b in glob[at].encode()]
        at += 1
    return out


class Automaton:
    """The globs side by side in one row of 64-bit words, the preferred ones in lower bits.

    A glob of m bytes and ``?`` has m + 1 bits; bit j is set while its first j elements match
    what was read. ``step[c]`` holds the bits that are reached by byte c from the bit below,
    ``loop[c]`` those that stay, because a star follows them. The lowest bit of a glob is never
    reached by a step, so the shift may carry over borders of globs and words alike.
    """

    def __init__(self, globs: Sequence[str]):
        parsed = [_elements(g) for g in globs]
        sizes = [1 + sum(e not in ("*", "**") for e in p) for p in parsed]
        self.words = -(-sum(sizes) // 64)
        step, loop = (np.zeros((256, self.words * 64), dtype=bool) for _ in range(2))
        start, final, stay = (np.zeros(self.words * 64, dtype=bool) for _ in range(3))
        self.glob_of = np.full(self.words * 64, -1, dtype=np.int64)
        slash = np.arange(256) == ord("/")
        at = 0
        for number, (elements, size) in enumerate(zip(parsed, sizes)):
            bit = at
            start[bit] = True
            for e in elements:
                if e == "**":
                    loop[:, bit] = True
                elif e == "*":
                    loop[:, bit] |= ~slash
                else:
                    bit += 1
                    step[:, bit] = ~slash if e == "?" else np.arange(256) == e[0]
            final[bit] = True
            stay[bit] = loop[:, bit].all()
            self.glob_of[bit] = number
            at += size
        self.step, self.loop = (_words(table) for table in (step, loop))
        self.start, self.final, self.moving = _words(start), _words(final), ~_words(stay)

    def first_match(self, data: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The number of the first glob that matches each text, -1 if none does.

        Text i is ``data[ends[i]:ends[i + 1]]``. All texts take their next byte together; a
        text is left once it ends, or once all that is set are globs that match whatever
        follows, so what lies behind the reach of the rules costs nothing.
        """
        n = len(ends) - 1
        found = np.full(n, -1, dtype=np.int64)
        if not self.words:
            return found
        rows, state, at = np.arange(n), np.tile(self.start, (n, 1)), 0
        while rows.size:
            goes = (ends[rows] + at < ends[rows + 1]) & (state & self.moving).any(axis=1)
            if not goes.all():
                found[rows[~goes]] = self._first(state[~goes])
                rows, state = rows[goes], state[goes]
            byte = data[ends[rows] + at]
            carried = state << _ONE
            carried[:, 1:] |= state[:, :-1] >> _TOP
            state = (carried & self.step[byte]) | (state & self.loop[byte])
            at += 1
        return found

    def _first(self, state: np.ndarray) -> np.ndarray:
        hits = state & self.final
        word = (hits != 0).argmax(axis=1)
        held = hits[np.arange(len(hits)), word]
        lowest = held & (~held + _ONE)
        bit = np.frexp(lowest.astype(np.float64))[1] - 1  # a power of two, exact in a double
        return np.where(held != 0, self.glob_of[word * 64 + np.maximum(bit, 0)], -1)


def _words(bits: np.ndarray) -> np.ndarray:
    """Booleans in rows of 64 to little-endian words."""
    return np.packbits(bits, axis=-1, bitorder="little").view("<u8").astype(np.uint64)


def _buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of the texts, which hold no nulls, and where each begins and the last ends."""
    texts = texts.cast(pa.large_binary())
    _, ends, data = texts.buffers()
    ends = np.frombuffer(ends, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    return np.frombuffer(data, dtype=np.uint8) if data else np.empty(0, np.uint8), ends


def matched_rule(canonical: Column, rules: Sequence[Rule]) -> Column:
    """``struct<rule, verdict>`` of the rule with the longest text that matches, null fields if
    none does; of equally long ones the first."""
    ranked = sorted(rules, key=lambda r: -len(r.text))
    automaton = Automaton([r.glob for r in ranked])
    names, verdicts = (pa.array([getattr(r, c) for r in ranked], pa.string()) for c in ("text", "verdict"))
    rows = max(1, STATE_WORDS // max(1, automaton.words))

    @F.arrow_udf(T.StructType([T.StructField("rule", T.StringType()), T.StructField("verdict", T.StringType())]))
    def judge(urls: pa.Array) -> pa.Array:
        found = [automaton.first_match(*_buffers(urls.slice(at, rows))) for at in range(0, len(urls), rows)]
        number = np.concatenate(found) if found else np.empty(0, np.int64)
        index = pa.array(number, mask=number < 0)
        return pa.StructArray.from_arrays([names.take(index), verdicts.take(index)], ["rule", "verdict"])

    return judge(canonical)


def url_host(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in small letters;
    empty for null and without ``://``."""
    return ascii_lower(F.regexp_extract(_behind_scheme(url), "^[^/?#]*", 0))


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_behind_scheme(url), "^[^/?#]*([^?#]*)", 1)


def _behind_scheme(url: Column) -> Column:
    at = F.locate("://", url)
    return F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))


def judge_urls(pages: DataFrame, rules: Sequence[Rule], default: str = "allow", key: str = "page_id") -> DataFrame:
    """Per row of ``pages``: key, host, path, the rule that decides, and its verdict.

    The longest rule that matches wins, the first of equally long ones. Where none matches,
    rule is null and the verdict is ``default``. Null URLs and those without ``://`` have an
    empty host and path and go through the rules like others. Every row of a repeated key is
    judged; an empty table gives no rows; other columns are not read. One narrow pass without
    a shuffle; a task holds one Arrow batch of URLs, however long, and at most about
    ``STATE_WORDS`` words of state. The masks, 4 KB per 64 bits of globs, go along with the task.
    """
    parts = pages.select(F.col(f"`{key}`"), url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"))
    judged = parts.withColumn("_found", matched_rule(F.concat(F.lit("."), "host", "path"), rules))
    verdict = F.coalesce(F.col("_found.verdict"), F.lit(default))
    return judged.select(F.col(f"`{key}`"), "host", "path", F.col("_found.rule").alias("rule"), verdict.alias("verdict"))
