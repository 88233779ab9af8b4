"""URL rules, phrases and divergence of sources against plain Python."""

import random
import re
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from metricspark.llm import divergence, phrases, urlfilter

from .conftest import lower

# --- URL rules ------------------------------------------------------------------------


def glob_regex(glob):
    out, at = "", 0
    while at < len(glob):
        c = glob[at]
        if glob[at : at + 2] == "**":
            out, at = out + ".*", at + 1
        elif c == "*":
            out += "[^/]*"
        elif c == "?":
            out += "[^/]"
        else:
            at += c == "\\" and at + 1 < len(glob)
            out += re.escape(glob[at])
        at += 1
    return re.compile(out, re.DOTALL)


def first_matches(globs, texts):
    automaton = urlfilter.Automaton(globs)
    data = b"".join(texts)
    ends = np.cumsum([0, *map(len, texts)])
    return automaton.first_match(np.frombuffer(data, np.uint8), ends).tolist()


def brute_first(globs, text):
    return next((i for i, g in enumerate(globs) if glob_regex(g).fullmatch(text)), -1)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text("ab/*?\\", max_size=12), max_size=30), st.lists(st.text("ab/", max_size=15), max_size=12))
def test_automaton_against_regular_expressions(globs, texts):
    assert first_matches(globs, [t.encode() for t in texts]) == [brute_first(globs, t) for t in texts]


def test_automaton_over_words_of_state():
    long = "x" * 200
    globs = [f"*{long}y", "**", f"{long}/a*b**", long]
    texts = [long + "y", "zz" + long + "y", long, long + "/aqqb//", "", long[:-1]]
    assert first_matches(globs[:1] + globs[2:], [t.encode() for t in texts]) == [0, 0, 2, 1, -1, -1]
    assert first_matches(globs, [t.encode() for t in texts]) == [0, 0, 1, 1, 1, 1]
    assert first_matches([], [b"a", b""]) == [-1, -1]


RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block"), ("a*b.net", "/?", "block")]


def brute_url(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    raw = re.match("[^/?#]*", rest).group()
    host, path = lower(raw), re.match("[^?#]*", rest[len(raw) :]).group()
    fits = [r for r in RULES if ("." + host).endswith("." + r[0]) and path.startswith(r[1])]
    best = max(fits, key=lambda r: len(r[0] + r[1]), default=None)
    return host, path, best and best[0] + best[1], best[2] if best else "allow"


def test_urls_against_plain_python(spark):
    urls = [
        None, "", "no scheme", "http://", "https://EXAMPLE.org/es/x?q", "https://www.example.org/es", "x://example.org/en/12#f", "x://org", "x://org/",
        "a://b.com/fr/1", "a://b.com/de/", "a://com/DE/", "a://notexample.org/es/", "http://b.com?x=http://c.org/", "h://é.Ä.org/é", "x://u@h.org:80/p",
        "x://a*b.net/?", "x://a*b.net/\\?", "x://axb.net/q", "x://b.com/x/.c.org/", "//://org/", "h://org/" + "long/" * 40_000, "h://" + "s." * 30_000 + "com/fr/",
    ]
    rows = [(i, u, "clash") for i, u in enumerate(urls)] + [(0, None, None), (4, urls[4], "again"), (None, urls[4], None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string").selectExpr("*", "host AS path", "host AS rule", "host AS _found")
    rules = [urlfilter.host_rule(*r) for r in RULES]
    got = [tuple(r) for r in urlfilter.judge_urls(pages, rules).collect()]
    assert sorted(map(str, got)) == sorted(str((i, *brute_url(u))) for i, u, _ in rows)
    assert urlfilter.judge_urls(pages.limit(0), rules).collect() == []
    assert {r["verdict"] for r in urlfilter.judge_urls(pages, [], "block").collect()} == {"block"}


def test_longest_rule_wins_and_then_the_first(spark):
    pages = spark.createDataFrame([(1, "h://a.b/c/d")], "page_id long, url string")
    rules = [urlfilter.Rule("ab", "**/c/**", "x"), urlfilter.Rule("zz", "*/c/**", "y"), urlfilter.Rule("a", "**", "z")]
    assert urlfilter.judge_urls(pages, rules).first()["verdict"] == "x"
    assert urlfilter.judge_urls(pages, rules[::-1]).first()["verdict"] == "y"


# --- phrases --------------------------------------------------------------------------


def brute_phrases(docs, min_count, max_words, top, absorb=50):
    f, n = defaultdict(Counter), Counter()
    for lang, text in docs:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text)):
            words = re.findall(r"[^\x20\x09]+", piece)
            lang_key = "und" if lang is None else lang
            n[lang_key] += len(words)
            for k in range(1, max_words + 1):
                f[lang_key].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, counts in f.items():
        rows = []
        often = {p: a for p, a in counts.items() if len(p) > 1 and a >= min_count}
        for p, a in often.items():
            score, k = min((1_000_000 * a * a // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p)))
            inside = [b for q, b in often.items() if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q)))]
            if not any(100 * b >= absorb * a for b in inside):
                rows.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (s, a, p, left, right) in enumerate(sorted(rows)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -s))
    return sorted(out)


def phrase_rows(df):
    return sorted(tuple(r) for r in df.collect())


def phrase_docs(seed, rows=120):
    draw = random.Random(seed)
    words = ["der", "Der", "hund", "été", "a\u00a0b", "x\x00", "'t", "new", "york", "city", "I'm"]
    ends = [" ", " ", " ", "  ", "\t", ". ", ",", "\n", "!?"]
    text = lambda: "".join(draw.choice(words) + draw.choice(ends) for _ in range(draw.randrange(60)))
    docs = [(draw.choice(["en", "de", None, "und", ""]), text()) for _ in range(rows)]
    return docs + [("en", None), (None, ""), ("en", " \t. ,"), ("en", "new york city " * 300), ("en", "one"), *docs[:5]]


@pytest.mark.parametrize("max_words,chunk_words,slot_words", [(3, 1 << 19, 1 << 21), (3, 40, 64), (4, 200, 500), (2, 100, 1 << 21)])
def test_phrases_against_plain_python(spark, monkeypatch, max_words, chunk_words, slot_words):
    monkeypatch.setattr(phrases, "SLOT_WORDS", slot_words)
    docs = phrase_docs(max_words)
    table = spark.createDataFrame([(*d, "clash") for d in docs], "lang string, text string, chunk string").selectExpr("*", "chunk AS part", "chunk AS word")
    got = phrases.mine_phrases(table.repartition(3), 5, max_words, 30, chunk_words=chunk_words)
    want = brute_phrases(docs, 5, max_words, 30)
    assert phrase_rows(got) == want and len(want) > 30


def test_phrases_of_nothing(spark):
    empty = spark.createDataFrame([], "lang string, text string")
    assert phrases.mine_phrases(empty).collect() == []
    rare = spark.createDataFrame([("en", "a b c"), ("en", None)], "lang string, text string")
    assert phrases.mine_phrases(rare).collect() == []


def test_scores_do_not_overflow(spark):
    big = 900_000_000_000_000
    parts = spark.createDataFrame([([1], big), ([2], big), ([1, 2], big - 1)], "ids array<bigint>, f bigint")
    pair = parts.where("size(ids) = 2").selectExpr("ids", "f AS a")
    assert phrases._cuts(pair, parts).first()["score"] == 1_000_000 * (big - 1) ** 2 // big**2


# --- divergence -----------------------------------------------------------------------


def brute_audit(docs, min_docs, top):
    seen, counts, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for lang, source, text in docs:
        lang, source = lang or "", source or ""
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lower(text))
        seen[lang].update(set(terms))
        counts[lang, source].update(terms)
        groups[lang].add(source)
    out = []
    for lang, sources in groups.items():
        kept = [t for t, d in seen[lang].items() if d >= min_docs]
        whole = sum((counts[lang, s] for s in sources), Counter())

        def share(own, t):
            return 1 + (1_000_000_000 * (own[t] + 5)) // (sum(own[k] for k in kept) + 5 * len(kept))

        p = {s: {t: share(counts[lang, s], t) for t in kept} for s in sources}
        q = {t: share(whole, t) for t in kept}
        for s in sources:
            pairs = [(-sum(abs(p[s][t] - p[o][t]) for t in kept), o.encode()) for o in sources if o != s]
            terms = [(q[t] - p[s][t], t.encode()) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for part, rows in (("pair", sorted(pairs)), ("term", sorted(terms)[:top])):
                out += [(lang, s, part, item.decode(), -v, rank) for rank, (v, item) in enumerate(rows, 1)]
    return sorted(out)


@pytest.mark.parametrize("held", [1_000_000, 3])
def test_divergence_against_plain_python(spark, monkeypatch, held):
    monkeypatch.setattr(divergence, "HELD", held)
    draw = random.Random(held)
    words = [f"{a}{b}" for a in "abcdefghijkl" for b in ("x", "Y", "é", "zz", "q", "ß", "i", "o")]

    def text():
        return draw.choice([" ", "-1", "\n"]).join(words[min(int(draw.expovariate(0.06)), len(words) - 1)] for _ in range(draw.randrange(70)))

    docs = [(draw.choice(["en", "de", None]), draw.choice(["a", "a", "b", "ü", None, ""]), text()) for _ in range(150)]
    docs += [("en", "bare", None), ("fr", "one", "not kept"), ("fr", "two", ""), ("x", None, "alone"), ("en", "long", "ax BY " * 40_000), *docs[:3]]
    table = spark.createDataFrame([(*d, "clash") for d in docs], "lang string, source string, text string, term string")
    table = table.selectExpr("*", "term AS n", "term AS p", "term AS item", "term AS total")
    got = sorted(tuple(r) for r in divergence.audit_sources(table.repartition(3), 8, 4).collect())
    assert got == brute_audit(docs, 8, 4)


def test_divergence_of_nothing(spark):
    assert divergence.audit_sources(spark.createDataFrame([], "lang string, source string, text string")).collect() == []


def test_shares_are_exact(spark):
    count, total, terms = 3_000_000_000_000_000, 7_000_000_000_000_001, 12_345
    from pyspark.sql import functions as F

    got = spark.range(1).select(divergence.share(*(F.lit(x).cast("bigint") for x in (count, total, terms))).alias("p")).first()["p"]
    assert got == 1 + int(Fraction(1_000_000_000 * (count + 5), total + 5 * terms))
