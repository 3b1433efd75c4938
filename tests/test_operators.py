"""Relational operators on small hand-written rows."""

import json
import random

import pytest

from palimpsest.functions import dates, ids, quantities, text
from palimpsest.operators import chains, diff, gates, grids, latest, links, parity, resolution, tagging
from pyspark.sql import functions as F


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_runs_are_not_distincts(spark):
    df = spark.createDataFrame([("k", 1, "A", "e1"), ("k", 2, "A", "e2"), ("k", 4, "B", "e4"), ("k", 9, "A", "e9"), ("n", 1, None, "x"), ("n", 2, None, "y")], "k string, o int, t string, l string")
    states = chains.text_states(df, ["k"], "o", F.col("t"), "l")
    got = [(r.k, r.state_order, r.state_value, r.first_order, r.last_order, r.observation_count, r.labels) for r in states.orderBy("k", "state_order").collect()]
    assert got == [("k", 0, "A", 1, 2, 2, ["e1", "e2"]), ("k", 1, "B", 4, 4, 1, ["e4"]), ("k", 2, "A", 9, 9, 1, ["e9"]), ("n", 0, None, 1, 2, 2, ["x", "y"])]
    edges = rows(chains.state_edges(states, ["k"]))
    assert edges == [("k", 0, 1, 2, 4, True), ("k", 1, 2, 4, 9, True)]
    assert rows(chains.presence(df, ["k"], "o", "t").select("k", "observed", "unique_values", "contiguous")) == [("k", 4, 2, False), ("n", 2, 0, True)]


def test_nested_ranges_end_at_the_same_depth_or_above(spark):
    depths = [1, 2, 3, 3, 2, 1, 2]
    df = spark.createDataFrame([("c", i, d) for i, d in enumerate(depths)], "c string, o int, d int")
    got = {r.o: r.range_end for r in chains.nested_ranges(df, ["c"], "o", "d").collect()}
    want = {i: next((j for j in range(i + 1, len(depths)) if depths[j] <= d), None) for i, d in enumerate(depths)}
    assert got == want


def test_latest_then_filter_is_not_filter_then_latest(spark):
    df = spark.createDataFrame([("a", 1, "activate"), ("a", 2, "activate"), ("a", 3, "deactivate"), ("b", 1, "activate")], "k string, n int, action string")
    assert rows(latest.latest_then(df, ["k"], ["n"], F.col("action") == "activate")) == [("b", 1, "activate")]
    assert rows(latest.latest_rows(df, [], ["n", "k"])) == [("a", 3, "deactivate")]
    one, more = latest.exactly_one(df, ["k"])
    assert rows(one) == [("b", 1, "activate")] and rows(more) == [("a", 3)]


def test_half_open_validity(spark):
    df = spark.createDataFrame([(1, 5, 5), (1, 5, 4), (1, None, 99), (None, 5, 2), (3, 5, 2)], "s int, e int, at int")
    assert [r[0] for r in df.select(latest.valid_at(F.col("s"), F.col("e"), F.col("at"))).collect()] == [False, True, True, False, False]


def test_bags_and_groups(spark):
    a = spark.createDataFrame([("x",), ("x",), ("y",), (None,)], "k string")
    b = spark.createDataFrame([("x",), ("z",), (None,), (None,)], "k string")
    assert rows(parity.bag_parity(a, b, ["k"])) == sorted([("x", 1, 1, 0), ("y", 0, 1, 0), ("z", 0, 0, 1), (None, 1, 0, 1)], key=repr)
    assert rows(parity.relation_difference(a, b)) == sorted([("x", "left"), ("y", "left"), ("z", "right"), (None, "right")], key=repr)
    l = spark.createDataFrame([("k", 1), ("k", 2), ("m", 1), (None, 3)], "k string, v int")
    r = spark.createDataFrame([("k", 9), ("k", 9), ("n", 1)], "k string, w int")
    got = {x.k: (x.left_values, x.right_values, x.left_count, x.right_count, x.status, x.collides) for x in parity.grouped_reconcile(l, r, "k", "v", "w").collect()}
    assert got == {"k": ([1, 2], [9], 2, 2, "both", True), "m": ([1], None, 1, 0, "left_only", False), "n": (None, [1], 0, 1, "right_only", False)}
    new = parity.unseen_rows(spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "k string, v int"), spark.createDataFrame([("b",)], "k string"), ["k"])
    assert [r.k for r in new.collect()] == ["a"]


def test_gates(spark):
    df = spark.createDataFrame([("a", 0, 5), ("a", 5, 9), ("a", 7, None), ("a", 50, 60), ("b", 0, 1)], "k string, s int, e int")
    assert rows(gates.overlapping_intervals(df, ["k"], "s", "e")) == [("a", 50, 60), ("a", 7, None)]
    assert rows(gates.leaf_mismatches(spark.createDataFrame([("1",), ("1.2",), ("1.2.3",), ("10.2",)], "c string"), [], "c")) == [("1.2.3",), ("10.2",)]
    seq = spark.createDataFrame([("a", 0), ("a", 1), ("b", 0), ("b", 2), ("c", 1), ("d", 0), ("d", 0)], "k string, n int")
    assert [r.k for r in gates.broken_sequences(seq, ["k"], "n").orderBy("k").collect()] == ["b", "c", "d"]
    spans = spark.createDataFrame([("字體x", 1, 2, "體"), ("字體x", 0, 2, "字x")], "t string, s int, e int, want string")
    assert rows(gates.wrong_slices(spans, "t", "s", "e", "want").select("want")) == [("字x",)]
    assert gates.wrong_slices(spark.createDataFrame([("字體", 3, 6, "體")], "t string, s int, e int, want string"), "t", "s", "e", "want", utf8=True).isEmpty()
    with pytest.raises(gates.GateError):
        gates.require_empty(gates.duplicate_keys(seq, ["k"]), "keys")
    ranges = gates.assembled_ranges(spark.createDataFrame([("k", 0, "ab"), ("k", 1, "字")], "k string, o int, t string"), ["k"], "o", "t", "\n")
    assert [(r.scalar_start, r.scalar_end, r.byte_start, r.byte_end) for r in ranges.orderBy("o").collect()] == [(0, 2, 0, 2), (3, 4, 3, 6)]


def test_resolution_lattice(spark):
    markers = spark.createDataFrame([("m1", "d1", "A"), ("m2", "d1", None), ("m3", None, "A"), ("m4", "d9", "A"), ("m5", "d2", "B"), ("m6", "d3", "A")], "m string, d string, x string")
    events = spark.createDataFrame([("e1", "d1", "A"), ("e2", "d1", "B"), ("e3", "d2", "A"), ("e4", "d3", None)], "e string, d string, x string")
    got = {r.marker: r.status for r in resolution.resolve_markers(markers, events, marker="m", event="e", date="d", designation="x").collect()}
    assert got == {"m1": "resolved", "m2": "ambiguous", "m3": "invalid_date", "m4": "no_match", "m5": "no_compatible", "m6": "indeterminate"}


def test_three_valued_logic(spark):
    t = lambda *v: [F.lit(x).cast("short") for x in v]
    one = spark.range(1)
    value = lambda c: one.select(c.alias("x")).first().x
    assert [value(resolution.all_of(t(*v))) for v in ((1, 1), (1, -1), (0, -1))] == [1, -1, 0]
    assert [value(resolution.any_of(t(*v))) for v in ((0, 0), (0, -1), (1, -1))] == [0, -1, 1]
    assert [value(resolution.at_least(t(*v), 2)) for v in ((1, 1, 0), (1, -1, 0), (1, 0, 0))] == [1, -1, 0]
    facts = F.lit(json.dumps({"yes": True, "no": False, "text": "true", "none": None}))
    assert [value(resolution.fact_truth(facts, n)) for n in ("yes", "no", "text", "none", "gone")] == [1, 0, -1, -1, -1]
    first = lambda *c: tuple(value(resolution.first_category([(n, F.lit(v).cast("short")) for n, v in c])))
    assert first(("a", 0), ("b", 1)) == ("b", "true") and first(("a", -1), ("b", 1)) == (None, "higher_priority_unknown") and first(("a", 0)) == (None, "none_true")


def test_coverage_reasons(spark):
    e = spark.createDataFrame([("a", "1"), ("a", "2"), ("a", "9"), ("b", "1"), ("c", "1")], "k string, v string")
    f = spark.createDataFrame([("a", "1"), ("a", "3"), ("b", "1"), ("o", "1")], "k string, v string")
    got = {r.k: (r.missing, r.unexpected, r.post_cut, r.reasons, r.complete) for r in resolution.coverage_audit(e, f, "k", "v", F.lit("5")).collect()}
    assert got["a"] == (["2"], ["3"], ["9"], ["values_missing", "values_unexpected", "values_after_cut"], False)
    assert got["b"] == ([], [], [], [], True)
    assert got["c"][3] == ["no_evidence", "values_missing"] and got["o"][3] == ["not_expected", "values_unexpected"]


def test_illegal_transitions(spark):
    log = spark.createDataFrame([("k", 1, "new"), ("k", 2, "done"), ("j", 1, "done")], "k string, n int, s string")
    allowed = spark.createDataFrame([(None, "new"), ("new", "done")], "from_state string, to_state string")
    assert rows(resolution.illegal_transitions(log, ["k"], ["n"], "s", allowed).select("k", "n")) == [("j", 1)]


# Diffs


def test_exact_segments_give_back_both_texts():
    rng = random.Random(0)
    for _ in range(100):
        a = "".join(rng.choice("ab字é") for _ in range(rng.randrange(12)))
        b = "".join(rng.choice("ab字é") for _ in range(rng.randrange(12)))
        made = diff.exact_segments(a, b)
        assert "".join(s["old_text"] or "" for s in made) == a and "".join(s["new_text"] or "" for s in made) == b
        for s in made:
            if s["old_text"] is not None:
                assert a[s["old_start"] : s["old_end"]] == s["old_text"] == a.encode()[s["old_byte_start"] : s["old_byte_end"]].decode()
    assert diff.exact_segments(None, None) == []


@pytest.mark.parametrize(
    ("old", "new", "kind", "ignored"),
    [
        ("ab c", "abc", "format_only", ["whitespace"]), ("ａb", "ab", "format_only", ["width_variant"]), ("a'b", "a’b", "format_only", ["single_quote"]),
        ("abc", "abd", "replaced", []), ("abc", "abcd", "added", []), ("abcd", "abc", "removed", []), (None, "x", "added", []), ("ß", "ss", "replaced", []),
    ],
)
def test_form_diff(old, new, kind, ignored):
    made = diff.form_diff(old, new)
    assert (made["change_kind"], made["ignored_classes"]) == (kind, ignored)
    for side, whole in (("old", old), ("new", new)):
        assert "".join(s["text"] for s in made["segments"] if s["side"] == side) == (whole or "")


def test_block_hunks(spark):
    df = spark.createDataFrame([("e", ["a", "b ", "c"], ["a", "b", "d", "e"]), ("same", ["x"], ["x "]), ("null", None, ["n"])], "edge string, o array<string>, n array<string>")
    got = rows(diff.block_hunks(df, "edge", "o", "n", lambda t: t.strip()))
    assert got == [("e", 0, "replaced", "c", "d\ne"), ("null", 0, "added", None, "n")]


def test_unique_matches_never_guess(spark):
    old = spark.createDataFrame([("s", "o1", "x", "1"), ("s", "o2", "y", "2"), ("s", "o3", "y", "3"), ("s", "o4", "q", "9")], "s string, i string, a string, b string")
    new = spark.createDataFrame([("s", "n1", "x", "5"), ("s", "n2", "y", "2"), ("s", "n3", "z", "3"), ("s", "n4", "w", "9"), ("s", "n5", "v", "9")], "s string, i string, a string, b string")
    got = rows(diff.unique_matches(old, new, ["s"], "i", "i", ["a", "b"]))
    assert got == sorted([("s", "o1", "n1", 0), ("s", "o2", "n2", 1), ("s", "o3", "n3", 1), ("s", "o4", None, None), ("s", None, "n4", None), ("s", None, "n5", None)], key=repr)


# Tagging


def occurrences(text_, *aliases):
    made = [{"alias_id": a, "concept_id": c, "alias_text": t, "status": s} for a, c, t, s in aliases]
    return [(m["alias_id"], m["start"], m["end"], m["status"], m["reason"]) for m in tagging.resolve(tagging.Dictionary(made).matches(text_))]


def test_tagging_longest_match_and_alias_wide_loss():
    aliases = [("s", "c1", "藥物", "admitted"), ("l", "c2", "抗癌藥物", "admitted")]
    got = occurrences("抗癌藥物與藥物", *aliases)
    assert got == [("l", 0, 4, "admitted", "admitted"), ("s", 2, 4, "blocked", "overlap_lost"), ("s", 5, 7, "blocked", "overlap_lost")]


def test_tagging_boundaries_folding_and_conflicts():
    assert occurrences("xABC ABC abc1 ＡＢＣ", ("a", "c", "abc", "admitted")) == [("a", 5, 8, "admitted", "admitted"), ("a", 14, 17, "admitted", "admitted")]
    assert occurrences("10㎎", ("a", "c", "mg", "admitted")) == []  # a digit touches the folded unit
    assert occurrences("（㎎）", ("a", "c", "mg", "admitted")) == [("a", 1, 2, "admitted", "admitted")]
    assert occurrences("（㎎）", ("a", "c", "m", "admitted")) == []
    both = occurrences("心衰", ("a", "c1", "心衰", "admitted"), ("b", "c2", "心衰", "admitted"))
    assert [m[3:] for m in both] == [("blocked", "several_concepts")] * 2
    assert occurrences("aaa", ("a", "c", "啊", "admitted")) == []
    assert [m[3] for m in occurrences("哈哈哈", ("a", "c", "哈哈", "admitted"))] == ["blocked", "blocked"]


def test_tag_texts_and_receipts(spark):
    blocks = spark.createDataFrame([("b1", "字心衰藥"), ("b2", None), ("b3", "")], "b string, t string").withColumn("status", F.lit("clash"))
    aliases = spark.createDataFrame([("a", "c", "心衰", "admitted"), ("z", "c", "", "admitted")], "alias_id string, concept_id string, alias_text string, status string")
    found = tagging.tag_texts(blocks, aliases, block="b", text="t")
    assert rows(found.select("b", "start", "end", "byte_start", "byte_end", "matched_text")) == [("b1", 1, 3, 3, 9, "心衰")]
    assert rows(tagging.scan_receipts(blocks, found, "b")) == [("b1", 1, 0, 0, "matched"), ("b2", 0, 0, 0, "zero_match"), ("b3", 0, 0, 0, "zero_match")]


def test_grid(spark):
    cells = spark.createDataFrame([("t", 0, 0, 2, 1, "a"), ("t", 0, 1, 1, 2, "b"), ("t", 1, 1, 0, None, "c")], "t string, r int, c int, rs int, cs int, v string")
    got = {(r.row_index, r.column_index): (r.value, r.inherited) for r in grids.normalized_grid(cells, ["t"], "r", "c", "rs", "cs", "v").collect()}
    assert got == {(0, 0): ("a", False), (1, 0): ("a", True), (0, 1): ("b", False), (0, 2): ("b", True), (1, 1): ("c", False)}


# Functions


def test_date_markers(spark):
    t = "自112/6/1起，（113／7／2）及99/2 /1、113/2/30；1113/1/1"
    df = spark.createDataFrame([(t,), ("none",), (None,)], "t string")
    got = [r.m for r in df.select(dates.date_markers(F.col("t")).alias("m")).collect()]
    assert [(m.raw, m.iso, m.status) for m in got[0]] == [("112/6/1", "2023-06-01", "valid"), ("113／7／2", "2024-07-02", "valid"), ("99/2 /1", "2010-02-01", "valid"), ("113/2/30", None, "invalid")]
    assert all(t[m.start : m.end] == m.raw for m in got[0]) and got[1] == [] and not got[2]


def test_ids_and_fingerprints(spark):
    df = spark.createDataFrame([(2, "字"), (1, None)], "b int, a string")
    lines = sorted(json.dumps(x, sort_keys=True, ensure_ascii=False, separators=(",", ":")) for x in ({"b": 2, "a": "字"}, {"b": 1, "a": None}))
    assert sorted(r.x for r in df.select(ids.canonical_row(df).alias("x")).collect()) == lines
    one, two = (ids.row_set_fingerprint(d).first().fingerprint for d in (df, df.orderBy("b")))
    assert one == two != ids.portable_fingerprint(df).first().fingerprint
    assert ids.row_sum_fingerprint(df).first().fingerprint == ids.row_sum_fingerprint(df.repartition(3)).first().fingerprint
    import hashlib
    import uuid

    r = spark.range(1).select(ids.uuid_v5(str(uuid.NAMESPACE_URL), F.lit("x")).alias("v5"), ids.uuid_v8("n", F.lit("x")).alias("v8"), ids.stable_id("n", F.lit("a"), F.lit(1)).alias("s"), ids.canonical_json(F.lit('{"b": 1, "a": [2]}')).alias("j")).first()
    assert r.v5 == str(uuid.uuid5(uuid.NAMESPACE_URL, "x")) and uuid.UUID(r.v8).version == 8 and uuid.UUID(r.v8).variant == uuid.RFC_4122
    assert r.s == hashlib.sha256(b"n\x1fa\x1f1").hexdigest() and r.j == '{"a":[2],"b":1}'


def test_text_functions(spark):
    t = F.col("t")
    df = spark.createDataFrame([("Ａ　b’C ㎎",), (None,)], "t string")
    got = df.select(text.display_text(t), text.comparison_key(t), text.semantic_key(t), text.alias_key(t), text.reader_key(t)).collect()
    assert tuple(got[0]) == ("Ａ b’C ㎎", "ab’cmg", "abcmg", "a b’c mg", "ab’cmg") and tuple(got[1]) == (None,) * 5
    x = lambda c, v: spark.createDataFrame([(v,)], "t string").select(c.alias("x")).first().x
    assert x(text.designation_key(t), "２ .３。") == "2.3"
    assert x(text.document_number(t), "審字第 123 號") == "審字第123號" and x(text.document_number(t), "第1號、第2號") is None
    assert x(text.canonical_url(t), "HTTP://Ex.Org:80?q=1#f") == "http://ex.org/?q=1" and x(text.canonical_url(t), "nothing") is None
    assert x(text.keyword_set(t), " a, b，a ;") == ["a", "b"]
    assert x(text.display_title(t), "標題：說明。") == "標題" and x(text.display_title(t), "長" * 60) == "長" * 48 + "…"
    assert "".join(x(text.tokens(t), "Ab 12.5字，é")) == "Ab 12.5字，é"
    assert [x(text.outline_depth(t), v) for v in ("1.字", "(2)字", "一、字", "字")] == [2, 3, 1, None]
    assert text.heading_terms("Trastuzumab 與 HER2、乳癌 (EGFR) trastuzumab") == ["Trastuzumab", "HER", "乳癌", "EGFR"]
    assert x(text.public_text(t), "password=1") is False and x(text.public_text(t), "一般文字") is True
    assert x(text.chinese_integer(t), "一百零七") == 107


def test_label_and_strict_dates(spark):
    x = lambda c, v: spark.createDataFrame([(v,)], "t string").select(c.alias("x")).first().x
    t = F.col("t")
    assert tuple(x(dates.label_date(t), "給付規定 105年1月版")) == ("2016-01", "month") and tuple(x(dates.label_date(t), "99年版")) == ("2010", "year") and x(dates.label_date(t), "x") is None
    assert [x(dates.strict_iso_date(t)["error"], v) for v in ("2020-02-30", "", None, "2020-02-29", "2020/02/01")] == ["invalid", "missing", "missing", None, "invalid"]


def test_as_of_and_logical_blocks(spark):
    left = spark.createDataFrame([("k", 5), ("k", 1), ("j", 9)], "k string, t int").withColumn("v", F.lit("own"))
    right = spark.createDataFrame([("k", 2, "a"), ("k", 5, "b"), ("k", 5, "c"), ("k", 7, "d")], "k string, t int, w string")
    assert rows(latest.as_of(left, right, ["k"], "t", ["w"])) == sorted([("k", 5, "own", "c"), ("k", 1, "own", None), ("j", 9, "own", None)], key=repr)
    lines = [("d", 0, "1. 開頭"), ("d", 1, "接續。"), ("d", 2, "新段"), ("d", 3, "2. 下項"), ("d", 4, None), ("d", 5, "尾")]
    made = chains.logical_blocks(spark.createDataFrame(lines, "d string, o int, t string"), ["d"], "o", "t")
    assert [tuple(r) for r in made.orderBy("block_order").collect()] == [("d", 0, 0, 1, "1. 開頭接續。"), ("d", 1, 2, 2, "新段"), ("d", 2, 3, 4, "2. 下項"), ("d", 3, 5, 5, "尾")]


def test_outline_parents(spark):
    depths = [1, 2, 3, 3, 2, 1, 3]
    df = spark.createDataFrame([("c", i, d) for i, d in enumerate(depths)], "c string, o int, d int")
    got = {r.o: r.parent_order for r in chains.outline_parents(df, ["c"], "o", "d").collect()}
    assert got == {i: next((j for j in range(i - 1, -1, -1) if depths[j] < d), None) for i, d in enumerate(depths)}


def test_outlines_of_any_depth(spark):
    depths = [*range(1, 41), 17, 30, 16, 40, 1, 18, 18, 17, None, 16]
    df = spark.createDataFrame([("c", i, d) for i, d in enumerate(depths)], "c string, o int, d int")
    ends = {r.o: r.range_end for r in chains.nested_ranges(df, ["c"], "o", "d").collect()}
    parents = {r.o: r.parent_order for r in chains.outline_parents(df, ["c"], "o", "d").collect()}
    near = lambda at, places, fits: next((j for j in places if depths[at] and depths[j] and fits(depths[j], depths[at])), None)
    assert ends == {i: near(i, range(i + 1, len(depths)), lambda a, b: a <= b) for i in range(len(depths))}
    assert parents == {i: near(i, range(i - 1, -1, -1), lambda a, b: a < b) for i in range(len(depths))}
    assert chains.nested_ranges(df.limit(0), ["c"], "o", "d").collect() == chains.outline_parents(df.limit(0), ["c"], "o", "d").collect() == []


def test_empty_tables(spark):
    df = spark.createDataFrame([], "k string, o int, t string")
    assert chains.text_states(df, ["k"], "o", F.col("t")).isEmpty() and latest.latest_rows(df, ["k"], ["o"]).isEmpty()
    assert parity.grouped_reconcile(df, df, "k", "t", "t").isEmpty() and gates.overlapping_intervals(df, ["k"], "o", "o").isEmpty()
    assert diff.unique_matches(df, df, ["k"], "o", "o", ["t"]).isEmpty() and grids.normalized_grid(df, ["k"], "o", "o", "o", "o", "t").isEmpty()
    report = gates.gate_report({"keys": gates.duplicate_keys(df, ["k"])}).first()
    assert (report.gate, report.violations, report.passed) == ("keys", 0, True)


def test_fingerprints_of_groups_larger_than_a_batch(spark):
    import hashlib

    rows = [(None if i % 3 == 0 else "g" if i % 3 == 1 else f"own{i}", i) for i in range(900)]
    df = spark.createDataFrame(rows, "k string, n int").repartition(3)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    groups: dict = {}
    for k, n in rows:
        groups.setdefault(k, []).append(f'{{"n":{n}}}')
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        one, two = ids.row_set_fingerprint(df, ["n"], ("k",)), ids.portable_fingerprint(df, ["n"], ("k",))
        got, portable = ({r.k: (r.fingerprint, r.row_count) for r in d.collect()} for d in (one, two))
        # Hashes of a group are never gathered in one value.
        assert not [d for d in (one, two) if "collect_list" in d._jdf.queryExecution().optimizedPlan().toString()]
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    assert got == {k: (sha("".join(f"{h}\n" for h in sorted(sha(t + "\n") for t in texts))), len(texts)) for k, texts in groups.items()}
    assert portable == {k: (sha("\n".join(sorted(map(sha, texts)))), len(texts)) for k, texts in groups.items()}
    empty = ids.row_set_fingerprint(df.limit(0), ["n"]).collect()
    assert [tuple(r) for r in empty] == [(sha(""), 0)] and ids.row_set_fingerprint(df.limit(0), ["n"], ("k",)).collect() == []
    assert df.where("n = 5").select(ids.row_hash(df, ["n"], newline=False)).first()[0] == sha('{"n":5}')


def test_steps_are_those_of_difflib_at_any_length(monkeypatch):
    from difflib import SequenceMatcher

    rng = random.Random(41)
    monkeypatch.setattr(diff, "SMALL", 16)
    for _ in range(400):
        letters = rng.choice(["ab", "abc", "abcdefgh", "甲乙丙丁戊己庚辛壬癸子丑"])
        old = [rng.choice(letters) for _ in range(rng.randrange(60))]
        new = list(old)
        for _ in range(rng.randrange(8)):
            at = rng.randrange(len(new) + 1)
            new[at : at + rng.randrange(4)] = [rng.choice(letters) for _ in range(rng.randrange(5))]
        assert diff.steps(old, new) == SequenceMatcher(None, old, new, autojunk=False).get_opcodes()


def test_long_texts_are_compared_in_good_time():
    import time

    rng = random.Random(42)
    old = "".join(rng.choice("abcdefgh") for _ in range(20000))
    new = "".join(rng.choice("abcdefgh") if rng.random() < 0.02 else c for c in old)
    began = time.perf_counter()
    made = diff.exact_segments(old, new)
    assert time.perf_counter() - began < 2
    assert "".join(s["old_text"] or "" for s in made) == old and "".join(s["new_text"] or "" for s in made) == new


def test_closure_over_many_parents_and_cycles(spark):
    edges = [("m", "t1"), ("m", "t2"), ("t1", "r"), ("t2", "s"), ("s", "r"), ("r", "q"), ("q", "r"), ("m", "t1"), ("x", "x"), (None, "m"), ("m", None)]
    df = spark.createDataFrame(edges, "a string, b string")
    got = {(r.node, r.reached): (r.distance, r.path, r.on_cycle) for r in links.closure(df, "a", "b").collect()}
    assert {b for a, b in got if a == "m"} == {"t1", "t2", "r", "s", "q"}
    assert got["m", "r"] == (2, ["m", "t1", "r"], False) and got["r", "r"] == (2, ["r", "q", "r"], True) and got["x", "x"] == (1, ["x", "x"], True)
    assert links.closure(df.limit(0), "a", "b").collect() == []


def test_candidate_blockers_and_work_units(spark):
    markers = spark.createDataFrame([("m1", "d", "A", False), ("m2", "d", None, True), ("m3", None, "A", False)], "m string, d string, x string, vague boolean")
    events = spark.createDataFrame([("e1", "d", "A", None), ("e2", "d", "B", True)], "e string, d string, x string, cut boolean")
    found = resolution.candidate_blockers(markers, events, marker="m", event="e", date="d", designation="x", marker_flags=["vague"], event_flags=["cut"])
    assert {(r.marker, r.event): r.blockers for r in found.collect()} == {
        ("m1", "e1"): [], ("m1", "e2"): ["designation_incompatible", "event_cut"],
        ("m2", "e1"): ["designation_indeterminate", "marker_designation_omitted", "marker_vague"],
        ("m2", "e2"): ["designation_indeterminate", "event_cut", "marker_designation_omitted", "marker_vague"],
    }
    pairs = spark.createDataFrame([("p1", 1), ("p2", 2)], "k string, a int")
    candidates = spark.createDataFrame([("p1", 5), ("p9", 6)], "k string, b int")
    units = resolution.gap_work_units(pairs, candidates, "k", [("joint", 1, F.col("b").isNotNull())], ("none", 9), "2020-01-01", ["a", "b"]).collect()
    assert {(u.k, u.lane, u.priority) for u in units} == {("p1", "joint", 1), ("p2", "none", 9), ("p9", "unknown_pair", 0)} and len({u.row_sha256 for u in units}) == 3


def test_dataset_audit_counts_orphans(spark):
    rows = lambda *x: spark.createDataFrame(list(x), "k string, v string")
    got = resolution.dataset_audit(rows(("a", "1"), ("b", "1"), ("b", "9")), rows(("a", "1"), ("z", "1")), rows(("a", "x"), ("b", "x"), ("c", "x")), "k", "v", F.lit("5")).collect()
    assert [tuple(r) for r in got] == [(3, 3, 1, 1, 1, 1, 1, 1)]


def test_counts_of_unknown_facts(spark):
    for facts, three, two in [([1, 1, 1, 0], 1, 0), ([1, 1, -1, 0], -1, -1), ([1, 1, 0, 0], 0, 1), ([0, 0, 0, -1], 0, 0), ([-1, -1, 0, 0], 0, -1)]:
        truths = [F.lit(x).cast("short") for x in facts]
        assert tuple(spark.range(1).select(resolution.at_least(truths, 3), resolution.exactly(truths, 2)).first()) == (three, two)


def test_gates_over_attempts_activations_and_pages(spark):
    states = spark.createDataFrame([("u", 1, "open"), ("u", 5, "closed")], "u string, t int, s string")
    attempts = spark.createDataFrame([("a", "u", 0, "try"), ("b", "u", 1, "try"), ("c", "u", 6, "try")], "i string, u string, t int, k string")
    allowed = spark.createDataFrame([("try", "open")], "kind string, state string")
    assert {(r.i, r.s) for r in resolution.disallowed_attempts(attempts, states, ["u"], "t", "k", "s", allowed).collect()} == {("a", None), ("c", "closed")}
    runs = spark.createDataFrame([("r1", "h", "sealed"), ("r2", "h", "open"), ("r3", None, "sealed")], "r string, h string, s string")
    acts = spark.createDataFrame([("r1", "h"), ("r2", "x"), ("r3", "h"), ("r9", "h")], "r string, h string")
    assert {r.r: r.reasons for r in gates.invalid_activations(acts, runs, "r", "h", "s", "sealed").collect()} == {"r2": ["not_sealed", "other_hash"], "r3": ["other_hash"], "r9": ["unknown_run"]}
    pages = [("ok", 1, 1), ("ok", 1, 2), ("ok", 2, 3), ("gap", 1, 1), ("gap", 1, 2), ("gap", 3, 5), ("rank", 1, 1), ("rank", 1, 3), ("short", 1, 1), ("short", 2, 3), ("over", 1, 1), ("over", 1, 2), ("over", 1, 3)]
    got = {r.q: r.reasons for r in gates.broken_pages(spark.createDataFrame(pages, "q string, p int, k int"), ["q"], "p", "k", 2).collect()}
    assert got == {"gap": ["pages_missing"], "rank": ["ranks_broken"], "short": ["page_short"], "over": ["page_overfull"]}


def test_units_and_limits(spark):
    df = spark.createDataFrame([("每日上限為432公克，療程以9次為限；每45週複查轉胺酶，間隔至少90天。總量不超過3.5ＭＧ",), (None,), ("",)], "t string")
    got = df.select(quantities.limit_expressions(F.col("t")).alias("x")).collect()
    assert {(x.kind, x.value, x.unit) for x in got[0].x} == {("periodic_cap", 432.0, "gram"), ("duration_cap", 9.0, "time"), ("recurring_action", 45.0, "week"), ("interval", 90.0, "day")}
    assert got[1].x is None and got[2].x == []
    units = spark.createDataFrame([("MG",), ("µg",), ("ＭＧ",), ("斤",), (None,)], "u string").select(quantities.unit_of(F.col("u"))).collect()
    assert [r[0] for r in units] == ["milligram", "microgram", "milligram", None, None]
    with pytest.raises(Exception, match="no unit: 斤"):
        spark.createDataFrame([("斤",)], "u string").select(quantities.unit_of(F.col("u"), strict=True)).collect()


def test_transition_labels(spark):
    df = spark.createDataFrame([(["2010-01-01"], ["2010-01-01", "2012-03-04", None, "2011-01-01"]), (None, ["2012-03-04"]), (["2012-03-04"], ["2012-03-04"]), (None, None)], "a array<string>, b array<string>")
    got = [tuple(r.x) for r in df.select(chains.transition_label(F.col("a"), F.col("b")).alias("x")).collect()]
    assert got == [(2, 2, "older_version", "101年3月"), (1, 1, "previous_version", "101年3月"), (0, 1, "previous_version", None), (0, 1, "previous_version", None)]


def test_components_against_union_find(spark):
    rng = random.Random(51)
    edges = [(f"n{i:03}", f"n{i + 1:03}") for i in range(120)] + [(f"m{rng.randrange(80):02}", f"m{rng.randrange(80):02}") for _ in range(60)] + [("hub", f"h{i}") for i in range(50)] + [(None, "x"), ("y", "y")]
    parent: dict = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for x, y in edges:
        if None not in (x, y) and x != y:
            a, b = sorted((root(x), root(y)))
            parent[b] = a
    df = spark.createDataFrame(edges, "a string, b string")
    got = [tuple(r) for r in links.components(df, "a", "b").collect()]
    assert len(got) == len(set(got)) and dict(got) == {x: root(x) for x in list(parent)}
    assert links.components(df.limit(0), "a", "b").collect() == []


def test_canonical_codes(spark):
    df = spark.createDataFrame([("通則第07條",), ("通則 3",), ("8.30.23",), ("8.",), ("第3章",), ("",), (None,)], "d string")
    got = [tuple(r.x) for r in df.select(text.canonical_code(F.col("d")).alias("x")).collect()]
    assert got == [("0.7", 0, "assigned", None), ("0.3", 0, "assigned", None), ("8.30.23", 8, "official", None), *[(None, None, None, "unsupported")] * 3, (None, None, None, "missing")]


def test_field_index_and_lexicon(spark):
    df = spark.createDataFrame([("d", "Cat cat 3", None), ("e", "", "貓咪 cat"), ("f", None, None)], "k string, a string, b string")
    assert {tuple(r) for r in tagging.field_index(df, "k", ["a", "b"]).collect()} == {("cat", "a", "d", 2), ("3", "a", "d", 1), ("貓", "b", "e", 1), ("咪", "b", "e", 1), ("cat", "b", "e", 1)}
    codes = spark.createDataFrame([("C1",)], "c string")
    found, unknown = tagging.lexicon_presence(df, "k", "b", [("貓", ["C1", "C9"]), ("cat", ["C1"])], codes, "c")
    assert [tuple(r) for r in found.collect()] == [("e", ["cat", "貓"], ["C1", "C9"])] and [tuple(r) for r in unknown.collect()] == [("貓", "C9")]


def test_replay_problems(spark):
    wholes = spark.createDataFrame([("ok", "ab", "ac"), ("old", "xx", "c"), ("none", "a", None), ("both", "q", "q")], "k string, o string, n string")
    pieces = spark.createDataFrame([("ok", 0, "a", "a"), ("ok", 1, "b", "c"), ("old", 0, "x", "c"), ("both", 0, None, "z")], "k string, s int, o string, n string")
    assert {tuple(r) for r in diff.replay_problems(wholes, pieces, "k", "s", ("o", "n"), ("o", "n")).collect()} == {("old", "old_text"), ("none", "no_segments"), ("both", "both_texts")}
