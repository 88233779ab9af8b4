"""The parser against known documents, edge cases and samples that are written down and read back."""

import random
import time

from pyspark.sql import functions as F

from metricspark.functions.text import escape_label_value
from metricspark.schema import EXPOSITION_DOC
from metricspark.sources import exposition

# Own documents, one for each group of cases.
LABELLED = r"""# TYPE mails counter
mails{to="a=b,c",via="smtp"}      7 1650000000123
mails{to="x}y"} 8
mails{to="ends in brace}"}    9     1650000000456
mails    11     1650000000789
"""
ESCAPED = r"""# HELP temp In degrees, \
with a second line, \
and a third
# TYPE temp gauge
temp -3.25e-2
temp{unit="\"C\"",note="one\ntwo",dir="D:\\t"} 6.5E3
"""
UNDECLARED = "speed 12\nspeed{unit=\"km\"} 9 1650000000000\n"
BELOW_ZERO = "# TYPE depth gauge\ndepth{at=\"pole\"} -Inf -77\n"
OPEN_QUOTE = "# TYPE mode gauge\nmode{now=\"idle} 2\n"
FAMILIES = r"""# TYPE size histogram
size_bucket{le="10"} 1
size_bucket{le="+Inf"} 5
size_count 5
size_sum 71.5
# TYPE wait summary
wait{quantile="0.75"} 0.125
wait_sum 9.5
wait_count 6
"""


def parse(spark, *bodies, **kw):
    docs = spark.createDataFrame(
        [(str(i), "t", 1700000015, "ok", b) for i, b in enumerate(bodies)], EXPOSITION_DOC
    )
    rows = exposition.parse_exposition(docs, **kw).orderBy("doc_id", "line").collect()
    return [(r["name"], [(p["key"], p["value"]) for p in r["labels"]], r["value"], r["own_ts"]) for r in rows]


def test_labels_with_signs_spaces_and_times(spark):
    assert parse(spark, LABELLED) == [
        ("mails", [("to", "a=b,c"), ("via", "smtp")], 7.0, 1650000000123),
        ("mails", [("to", "x}y")], 8.0, None),
        ("mails", [("to", "ends in brace}")], 9.0, 1650000000456),
        ("mails", [], 11.0, 1650000000789),
    ]


def test_escapes_and_continued_help(spark):
    labels = [("unit", '"C"'), ("note", "one\ntwo"), ("dir", "D:\\t")]
    assert parse(spark, ESCAPED) == [("temp", [], -0.0325, None), ("temp", labels, 6500.0, None)]


def test_undeclared_names_give_nothing(spark):
    assert parse(spark, UNDECLARED) == []
    assert [v for *_, v, _ in parse(spark, "# HELP speed In knots \\\nspeed 1\n# TYPE speed gauge\n" + UNDECLARED)] == [12.0, 9.0]


def test_infinite_values_and_times_before_the_epoch(spark):
    assert parse(spark, BELOW_ZERO) == [("depth", [("at", "pole")], float("-inf"), -77)]


def test_an_open_quote_ends_with_the_labels(spark):
    assert parse(spark, OPEN_QUOTE) == [("mode", [("now", "idle")], 2.0, None)]


def test_family_members_have_their_types(spark):
    assert [(n, labels, v) for n, labels, v, _ in parse(spark, FAMILIES)] == [
        ("size_bucket", [("le", "10")], 1.0), ("size_bucket", [("le", "+Inf")], 5.0), ("size_count", [], 5.0), ("size_sum", [], 71.5),
        ("wait", [("quantile", "0.75")], 0.125), ("wait_sum", [], 9.5), ("wait_count", [], 6.0),
    ]
    # A bucket and a count are whole numbers, a sum is not.
    assert parse(spark, "# TYPE size histogram\nsize_bucket 1.5\nsize_count 2.5\nsize_sum 3.5\nsize 4\n") == [("size_sum", [], 3.5, None)]


def test_types_depend_on_order(spark):
    body = "a 1\n# TYPE a counter\na 2\na 2.5\n# TYPE b gauge\na 3\nb 1.5\n# TYPE a gauge\na 4.5\n# TYPE b counter\nb 1.5\n"
    assert [(n, v) for n, _, v, _ in parse(spark, body)] == [("a", 2.0), ("a", 3.0), ("b", 1.5), ("a", 4.5)]
    assert [(n, v) for n, _, v, _ in parse(spark, body, counter_mode="float")][1] == ("a", 2.5)


def test_later_unknown_kind_keeps_the_type(spark):
    assert [v for *_, v, _ in parse(spark, "# TYPE a gauge\n# TYPE a strange\na 1.5\n# TYPE a\na 2.5\n")] == [1.5, 2.5]


def test_values_and_times(spark):
    lines = ["1", "1.", ".5", "1e3", "-Inf", "+inf", "NaN", "1d", "0x1", "", ".", "1 5", "1 x", "1 5 6", "1\t2"]
    body = "# TYPE g gauge\n" + "\n".join("g " + v for v in lines)
    got = [(v if v == v else "nan", t) for _, _, v, t in parse(spark, body)]
    inf = float("inf")
    assert got == [
        (1.0, None), (1.0, None), (0.5, None), (1000.0, None), (-inf, None), (inf, None), ("nan", None), (1.0, 5), (1.0, 5),
    ]
    integers = "# TYPE c counter\nc +7\nc 7.0\nc 9223372036854775807\nc 9223372036854775808\nc{} 8 9\nc{} 8 9 10\n"
    assert [(v, t) for _, _, v, t in parse(spark, integers)] == [(7.0, None), (float(2**63 - 1), None), (8.0, 9)]


def test_label_edge_cases(spark):
    cases = {
        'a="1",': [("a", "1")],
        'a="1",junk': [("a", "1")],
        'a="1"junk': None,
        'a="1" ,b="2"': None,
        '="1"': None,
        "=": [],
        "": [],
        "a=": [],
        'a="1", b="2"': [("a", "1"), (" b", "2")],
        'a="x': [("a", "x")],
        'a="x\\': [("a", "x")],
        'a="ä\\"ö"': [("a", 'ä"ö')],
        'a="\\\\n"': [("a", "\\n")],
        'a="\\\\\\n\\q"': [("a", "\\\nq")],
        'a=\'1"': [("a", "1")],
        'a="1",a="2"': [("a", "1"), ("a", "2")],
    }
    for text, want in cases.items():
        got = parse(spark, "# TYPE g gauge\ng{" + text + "} 1\n")
        assert [labels for _, labels, *_ in got] == ([] if want is None else [want]), text


def test_carriage_returns_tabs_and_blank_lines(spark):
    body = "# TYPE g gauge\r\n\r\n \t \r\n\tg 1\r\ng{a=\"1\"}\t2 \r\n# HELP g x \\\r\ng 5\r\ng 3"
    assert [v for *_, v, _ in parse(spark, body)] == [1.0, 2.0, 3.0]


def test_help_continues_over_other_lines_only_after_help(spark):
    body = '# TYPE g gauge\ng{a="\\\ng 2\n# HELP g \\\n# TYPE g counter\\\ng 3\ng 4.5\n'
    assert [v for *_, v, _ in parse(spark, body)] == [2.0, 4.5]


def test_long_texts_do_not_overflow(spark):
    value = '\\"' * 60_000 + "\\n" * 60_000
    body = "# HELP g x\\\n" + "more\\\n" * 50_000 + "end\n# TYPE g gauge\n" + 'g{a="' + value + '"} 1\n'
    ((_, labels, v, _),) = parse(spark, body)
    assert v == 1.0 and labels == [("a", '"' * 60_000 + "\n" * 60_000)]


def test_failed_scrapes_have_no_lines(spark):
    docs = spark.createDataFrame([("0", "t", 1, "failed", None)], EXPOSITION_DOC)
    assert exposition.parse_exposition(docs).count() == 0


#: Members a declaration brings: suffix, and whether values are whole.
MEMBERS = {
    "gauge": [("", False)],
    "counter": [("", True)],
    "summary": [("", False), ("_sum", False), ("_count", True)],
    "histogram": [("_bucket", True), ("_sum", False), ("_count", True)],
}
SIGNS = ["a", "7", " ", ",", "=", "{", "}", "#", "\\", '"', "\n", "é", "\t", "漢"]


def drawn_samples(rng):
    """A dump as (declarations, samples of known content) before it is written down."""
    families = [(f"f{i}", rng.choice(list(MEMBERS))) for i in range(rng.randint(1, 4))]
    samples = []
    for _ in range(rng.randint(0, 12)):
        family, kind = rng.choice(families)
        suffix, whole = rng.choice(MEMBERS[kind])
        labels = [(f"k{i}", "".join(rng.choices(SIGNS, k=rng.randint(0, 8)))) for i in range(rng.randint(0, 3))]
        value = float(rng.randint(-50, 50)) if whole else rng.choice([rng.uniform(-5, 5), 1e300, float("inf")])
        samples.append((family + suffix, labels, whole, value, rng.choice([None, rng.randint(-(10**12), 10**12)])))
    return families, samples


def written(rng, families, samples):
    """The dump as text, with lines between that must not change what is read."""
    gap = lambda: " " * rng.randint(1, 3)
    noise = [
        "", "   ", "#", "# a remark", "# EOF", "undeclared 5", 'f0{k="1"x="2"} 1', "f0 one", "f0",
        "# HELP f0 says", "# HELP f0 goes on \\\nf0 99\\\n# TYPE f0 counter", "# TYPE other strange",
    ]
    lines = [f"# TYPE {name} {kind}" for name, kind in families]
    for name, labels, whole, value, ts in samples:
        escaped = ((k, v.replace("\\", "\\\\").replace('"', '\\"').replace("\n", "\\n")) for k, v in labels)
        text = "{" + ",".join(f'{k}="{v}"' for k, v in escaped) + "}" if labels or rng.random() < 0.2 else ""
        number = str(int(value)) if whole else repr(value)
        lines += rng.sample(noise, rng.randint(0, 2))
        lines.append(f"{name}{text}{gap()}{number}" + ("" if ts is None else f"{gap() if text else ' '}{ts}"))
    end = rng.choice(["\n", "\r\n"])
    return end.join(line.replace("\n", end) for line in lines) + rng.choice(["", end])


def test_written_samples_are_read_back(spark):
    rng = random.Random(11)
    drawn = [drawn_samples(rng) for _ in range(2000)]
    docs = spark.createDataFrame([(str(i), "t", 1, "ok", written(rng, *d)) for i, d in enumerate(drawn)], EXPOSITION_DOC)
    got = {}
    for r in exposition.parse_exposition(docs).orderBy("doc_id", "line").collect():
        sample = (r["name"], [(p["key"], p["value"]) for p in r["labels"]], r["value"], r["own_ts"])
        got.setdefault(int(r["doc_id"]), []).append(sample)
    for i, (_, samples) in enumerate(drawn):
        assert got.get(i, []) == [(name, labels, value, ts) for name, labels, _, value, ts in samples]


def test_escaped_values_round_trip(spark):
    values = ['"', "\\", "\n", "a\\nb", 'x"}\n,y="', "ünï", "", "\\\\\n\"" * 50]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    back = df.select("v", exposition.parse_labels(F.concat(F.lit('a="'), escape_label_value(F.col("v")), F.lit('"')))[0]["value"].alias("w"))
    assert all(r["v"] == r["w"] for r in back.collect())


def test_types_and_families(spark):
    docs = spark.createDataFrame(
        [("0", "t", 1, "ok", "# TYPE a counter\n# TYPE a gauge\n# TYPE s summary\n# TYPE h histogram\n# TYPE u untyped\n")],
        EXPOSITION_DOC,
    )
    types = {r["name"]: (r["series_type"], r["family_kind"]) for r in exposition.metric_types(docs).collect()}
    assert types == {
        "a": ("Gauge", "gauge"),
        "s": ("Counter", "summary"), "s_count": ("CounterInteger", "summary"), "s_sum": ("Counter", "summary"),
        "h_bucket": ("CounterInteger", "histogram"), "h_count": ("CounterInteger", "histogram"), "h_sum": ("Counter", "histogram"),
    }
    assert [r["family"] for r in exposition.families(docs, "histogram").collect()] == ["h"]


def test_nothing_is_shuffled(spark):
    docs = spark.createDataFrame([("0", "t", 1, "ok", LABELLED + ESCAPED + FAMILIES)], EXPOSITION_DOC)
    for df in (exposition.parse_exposition(docs), exposition.metric_types(docs), exposition.families(docs, "summary", "histogram")):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Window" not in plan and "Python" not in plan


def test_declarations_far_from_their_lines(spark):
    """Changed and repeated declarations, all before the lines and between them, against a loop."""
    rng = random.Random(5)
    for _ in range(30):
        known, lines, want = {}, [], []
        for _ in range(rng.randint(1, 60)):
            name = f"m{rng.randrange(6)}"
            if rng.random() < 0.5:
                kind = rng.choice(["counter", "gauge", "strange"])
                known[name] = known.get(name) if kind == "strange" else kind
                lines.append(f"# TYPE {name} {kind}")
            else:
                lines.append(f"{name} 1.5")
                if known.get(name) == "gauge":
                    want.append(name)
        assert [n for n, *_ in parse(spark, "\n".join(lines))] == want


def test_time_grows_with_the_lines_not_their_square(spark):
    def took(n):
        body = "".join(f"# TYPE m{i} gauge\n" for i in range(n)) + "".join(f"m{i} {i}\n" for i in range(n))
        started = time.perf_counter()
        assert len(parse(spark, body)) == n
        return time.perf_counter() - started

    took(500)
    small, large = (min(took(n) for _ in range(2)) for n in (2000, 8000))
    assert large < 8 * small  # four times the lines; sixteen times for a search of each line through all


def test_declarations_carried_by_lines_or_searched_give_the_same_types(spark, monkeypatch):
    """Few declarations go with the lines, many are searched in the dump's row: typed alike, the
    latest one up to the line's section counting."""
    pick = random.Random(3)
    names, kinds = ("a", "a_count", "b", "b_bucket", "c\td"), ("counter", "gauge", "summary", "histogram", "untyped")
    made = [
        f"# TYPE {pick.choice(('', ' ', chr(9) + ' '))}{pick.choice(names)}  {pick.choice(kinds)} x" if pick.random() < 0.4
        else f"{pick.choice(names)}{pick.choice(('', '_sum', '_count'))}{pick.choice(('', '{}'))} 1"
        for _ in range(120)
    ]
    docs = spark.createDataFrame([("d", "t", 0, "ok", "\n".join(made))], EXPOSITION_DOC)
    found = {}
    for bound in (0, 1000):
        monkeypatch.setattr(exposition, "CARRIED", bound)
        found[bound] = [tuple(r) for r in exposition.typed_lines(docs).select("line", "text", "series_type").orderBy("line").collect()]
    assert found[0] == found[1000]

    types = {"counter": {"": "CounterInteger"}, "gauge": {"": "Gauge"}, "summary": {"": "Counter", "_count": "CounterInteger", "_sum": "Counter"},
             "histogram": {"_bucket": "CounterInteger", "_count": "CounterInteger", "_sum": "Counter"}}
    known, expected = {}, []
    for line in made:
        if line.startswith("# TYPE "):
            words = [w for w in line.split(" ") if w.strip()]
            known |= {words[2] + suffix: t for suffix, t in types.get(words[3], {}).items()}
        else:
            name = line.split("{")[0] if "{" in line else line.split(" ")[0]
            expected.append((len(expected), line, known.get(name)))
    assert found[0] == expected
