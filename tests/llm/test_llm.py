"""Training-data operators against brute force and exact round trips."""

import random
import string
import subprocess
import sys
import time
import unicodedata
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from palimpsest.llm import arrays, leakage, lookalike, members, neardup, spans, tokenize, truncation
from pyspark.sql import functions as F

VOCABULARY = tokenize.VOCABULARY_DIR + "/byte_bpe_50k.tiktoken"
CHARS = "體重公斤以上之局部潰瘍病患施打特善麗舒不得與併用改以樂絡瑞口服懸液維持附賽多易轉診單及治療計畫書"


def words(rng, n):
    return "".join(rng.choice(CHARS) for _ in range(n))


# Arrays


@pytest.mark.parametrize("width", [2, 3, 5, 24, 31, 60])
def test_rolling_hash_depends_on_the_window_alone(width):
    rng = np.random.default_rng(0)
    points = rng.integers(0, 40000, 500).astype(np.uint32)
    hashes = arrays.rolling_hash(points, width)
    assert len(hashes) == 500 - width + 1 and len(set(hashes.tolist())) == len(hashes)
    other = np.concatenate([points[:7], points[100 : 100 + width]])
    assert arrays.rolling_hash(other, width)[-1] == hashes[100]


def test_steps_cover_the_column(monkeypatch):
    monkeypatch.setattr(arrays, "STEP", 10)
    texts = ["ab", None, "", "長" * 20, "é", "xyz"]
    seen = []
    for start, points, bounds in arrays.steps(pa.array(texts)):
        assert start == len(seen)
        seen += ["".join(map(chr, points[a:b])) for a, b in zip(bounds, bounds[1:])]
    assert seen == [t or "" for t in texts]


# p3


@pytest.mark.parametrize(
    ("a", "b"),
    [
        ("ａｂＣ１（）", "abC1()"), ("é", "é"), ("ệ", "ệ"), ("㎎/㎏", "mg/kg"), ("ﬁn", "fin"), ("a​b­c⁠﻿", "abc"), ("a　b c d", "a b c d"),
        ("раре", "pape"), ("ΑΒ", "AB"), ("⼈不", "人不"), ("µg", "μg"), ("한", "한"), ("…", "..."),
    ],
)
def test_texts_that_look_the_same(a, b):
    x, y = lookalike.consistent(pa.array([a, b])).to_pylist()
    assert x == y


@pytest.mark.parametrize(("a", "b"), [("A", "a"), ("m²", "m2"), ("O", "0"), ("l", "1"), ("a b", "a  b"), ("ab", "a b"), ("人", "入"), ("①", "1"), ("μ", "u")])
def test_texts_that_look_different(a, b):
    x, y = lookalike.consistent(pa.array([a, b])).to_pylist()
    assert x != y


def test_look_alike_letters_and_syllables():
    a, b = "ανρυκιѵѴЬᏒꓐꓓⲟ", "avpukivVbRBDo"
    assert lookalike.consistent(pa.array(list(a))).to_pylist() == list(b)
    whole = ["각", "가", "한글", "ㅎㅏㄴ"]
    parts = ["\u1100\u1161\u11a8", "\u1100\u1161", "한\u1100\u1173\u11af", "ㅎㅏㄴ"]
    assert lookalike.consistent(pa.array(parts)).to_pylist() == whole == lookalike.consistent(pa.array(whole)).to_pylist()


def test_marks_are_ordered_in_linear_time():
    text = "a" + "\u0301\u0323" * 20000 + "b\u0323\u0301"
    began = time.perf_counter()
    one, two = lookalike.consistent(pa.array([text, "a\u0323" + "\u0301\u0323" * 3])).to_pylist()
    assert time.perf_counter() - began < 5
    assert unicodedata.normalize("NFC", one) == one == unicodedata.normalize("NFC", text)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(max_size=30)), max_size=6))
def test_consistent_form_of_columns(texts):
    texts = [t if t is None else t.encode("utf-8", "ignore").decode() for t in texts]
    whole = lookalike.consistent(pa.array(texts, pa.string())).to_pylist()
    assert whole == [lookalike.consistent(pa.array([t], pa.string())).to_pylist()[0] for t in texts]
    assert lookalike.consistent(pa.array(whole, pa.string())).to_pylist() == whole


def test_same_look_pairs(spark):
    rows = [("1", "ab"), ("2", "ａｂ"), ("3", "ab"), ("3", "ab"), ("4", "AB"), ("5", None), (None, "ab"), ("6", ""), ("7", "​")]
    df = spark.createDataFrame(rows, "id string, t string").withColumn("f", F.lit(1))
    got = sorted(tuple(r) for r in lookalike.same_look_pairs(df, "id", "t").collect())
    assert got == [("1", "2"), ("2", "3"), ("6", "7")]
    assert lookalike.same_look_pairs(df.limit(0), "id", "t").collect() == []


def test_same_look_successors_and_parts(spark):
    rows = [("x1", "w", "e1", "ab"), ("x2", "w", "e2", "ａb"), ("x3", "w", "e3", "ａb"), ("x4", "v", "e2", "ab"), ("x5", "w", None, "ab")]
    df = spark.createDataFrame(rows, "id string, w string, e string, t string")
    pairs = spark.createDataFrame([("r", "e1", "e2"), ("r", "e2", "e3")], "series string, older string, newer string")
    got = [tuple(r) for r in lookalike.same_look_successors(df, pairs, record="id", entity="w", edition="e", text="t").collect()]
    assert got == [("x1", "x2")]
    parts = spark.createDataFrame([("h1", "x1", "ａ"), ("h2", "x1", "a"), ("h3", "x1", "c"), ("h4", "zz", "ａ"), ("h5", "x1", None), ("h6", "x1", "​")], "h string, o string, p string")
    got = [tuple(r) for r in lookalike.same_look_parts(parts, df, part="h", part_text="p", of="o", whole="id", whole_text="t").collect()]
    assert got == [("h1", "x1")]


# p4


def jaccard_pairs(rows, width, threshold):
    out = set()
    for i, (r, o, t) in enumerate(rows):
        for s, p, u in rows[:i]:
            if o != p and r != s and None not in (r, o, t, s, p, u) and neardup.similarity(t, u, width) >= threshold:
                out.add((min(r, s), max(r, s)))
    return out


def test_near_duplicates_against_brute_force(spark):
    rng = random.Random(5)
    rows = []
    for i in range(60):
        base = words(rng, rng.choice([6, 30, 120, 400]))
        rows.append((f"r{i}", f"o{i}", base))
        for j in range(3):
            chars = list(base)
            for _ in range(rng.randrange(1 + len(chars) // 25)):
                chars[rng.randrange(len(chars))] = rng.choice(CHARS)
            rows.append((f"r{i}.{j}", f"o{i}" if j == 2 else f"o{i}.{j}", "".join(chars)))
    rows += [("c1", "p1", "abc"), ("c2", "p2", "abc"), ("c3", "p3", ""), ("c4", "p4", ""), ("n", "n", None), (None, "n", "abc"), ("c1", "p1", "abc")]
    df = spark.createDataFrame(rows, "id string, owner string, text string")
    got = [tuple(r) for r in neardup.near_duplicates(df, record="id", owner="owner", text="text").collect()]
    want = jaccard_pairs(rows, 5, 0.75)
    assert len(got) == len(set(got)) and set(got) <= want
    assert len(want - set(got)) <= len(want) * 0.01
    assert neardup.near_duplicates(df.limit(0), record="id", owner="owner", text="text").collect() == []


def test_near_duplicate_groups(spark):
    rng = random.Random(15)
    base, other = words(rng, 200), words(rng, 200)
    edit = lambda t, n: t[:n] + "X" + t[n + 1 :]
    rows = [("a", "A", base), ("b", "B", edit(base, 50)), ("c", "C", edit(edit(base, 50), 150)), ("d", "D", other), ("e", "E", words(rng, 90)), ("f", "E", None)]
    # Copies of one owner alone are no group; copies of several owners are one, however many there are.
    rows += [(f"k{i:03}", "K", words(random.Random(3), 70)) for i in range(3)] + [(f"m{i:03}", f"M{i}", "同一") for i in range(300)] + [("d", "D", "同一")]
    df = spark.createDataFrame(rows, "id string, owner string, text string")
    got = {r.record: (r.group_id, r.records) for r in neardup.near_duplicate_groups(df, record="id", owner="owner", text="text").collect()}
    assert got == {x: ("a", 3) for x in "abc"} | {x: ("d", 301) for x in ["d", *[f"m{i:03}" for i in range(300)]]}
    assert neardup.near_duplicate_groups(df.limit(0), record="id", owner="owner", text="text").collect() == []


def test_estimate_is_close_and_registers_ignore_other_rows():
    rng = random.Random(6)
    base = words(rng, 500)
    other = base[:400] + words(rng, 100)
    texts = pa.array([base, other, "short", "", None, base])
    made = neardup._all_registers(texts, 5)
    assert (made[0] == made[5]).all() and (made[0] == neardup._all_registers(texts.slice(0, 1), 5)[0]).all()
    exact = neardup.similarity(base, other, 5)
    assert abs(neardup.estimate(made[:1], made[1:2])[0] - exact) < neardup.MARGIN / 2


# p5


def shared_pairs(rows, span):
    grams = defaultdict(set)
    for r, o, t in rows:
        if None not in (r, o, t):
            for i in range(len(t) - span + 1):
                grams[t[i : i + span]].add((r, o))
    return {(min(a[0], b[0]), max(a[0], b[0])) for own in grams.values() for a in own for b in own if a[1] != b[1] and a[0] != b[0]}


def test_shared_spans_against_brute_force(spark):
    rng = random.Random(8)
    passages = [words(rng, n) for n in (59, 60, 61, 75, 150)]
    rows = []
    for i in range(50):
        parts = [words(rng, rng.randrange(30))]
        for _ in range(rng.randrange(3)):
            p = rng.choice(passages)
            cut = rng.randrange(12)
            parts += [p[cut:] if rng.random() < 0.3 else p, words(rng, rng.randrange(1, 30))]
        rows.append((f"r{i}", f"o{i // 2}", "".join(parts)))
    rows += [("a" * 3, "x", "重" * 100), ("b" * 3, "y", "重" * 61), ("c", "z", "重" * 59), ("n", "n", None), (None, "m", passages[4]), ("r1", "o0", passages[3]), ("r1", "o0", passages[3])]
    rows += [("t1", "t1", passages[4]), ("t2", "t2", passages[4]), ("s", "s", "")]
    df = spark.createDataFrame(rows, "id string, owner string, text string").withColumn("record", F.lit(1))
    got = [tuple(r) for r in spans.shared_spans(df, record="id", owner="owner", text="text").collect()]
    assert len(got) == len(set(got)) and set(got) == shared_pairs(rows, 60)
    assert spans.shared_spans(df.limit(0), record="id", owner="owner", text="text").collect() == []


def test_shared_share(spark):
    rng = random.Random(9)
    p = words(rng, 80)
    a, b = words(rng, 20) + p + words(rng, 30), words(rng, 10) + p
    rows = [("a", "a", a), ("b", "b", b), ("c", "c", words(rng, 90)), ("d", "d", p[:50])]
    df = spark.createDataFrame(rows, "id string, owner string, text string")
    got = {r.record: (r.texts, r.characters, r.shared) for r in spans.shared_share(df, record="id", owner="owner", text="text").collect()}
    assert got == {"a": (1, 130, 80), "b": (1, 90, 80), "c": (1, 90, 0)}


def test_hot_keys_are_split(spark, monkeypatch):
    monkeypatch.setattr(members, "TOGETHER", 7)
    rng = random.Random(10)
    p = words(rng, 80)
    rows = [(f"r{i:02}", f"o{i % 20}", p if i % 3 else words(rng, 5) + p) for i in range(40)]
    df = spark.createDataFrame(rows, "id string, owner string, text string")
    want = {(a, b) for a, o, _ in rows for b, q, _ in rows if a < b and o != q}
    assert {tuple(r) for r in spans.shared_spans(df, record="id", owner="owner", text="text").collect()} == want
    assert {tuple(r) for r in neardup.near_duplicates(df, record="id", owner="owner", text="text").collect()} == want
    looks = spark.createDataFrame([(f"r{i:02}", ["ab", "ａb", "aｂ"][i % 3]) for i in range(40)], "id string, t string")
    got = {tuple(r) for r in lookalike.same_look_pairs(looks, "id", "t").collect()}
    assert got == {(f"r{i:02}", f"r{j:02}") for i in range(40) for j in range(i + 1, 40) if i % 3 != j % 3}


# p8


@pytest.fixture(scope="module")
def reference_encoding():
    return tiktoken.Encoding("own", pat_str=tokenize.PATTERN, mergeable_ranks=tokenize.read_ranks(VOCABULARY), special_tokens={})


@pytest.fixture(scope="module")
def model():
    return tokenize.ByteBpe(VOCABULARY)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from("'stmdrevl \n\t　 aZ9é中。!?0\U0001f600"), st.characters(codec="utf-8")), max_size=40), min_size=1, max_size=4))
def test_encoding_and_round_trip(model, reference_encoding, texts):
    ids = model.encode(texts)
    assert ids == [reference_encoding.encode_ordinary(t) for t in texts]
    assert [model.decode(x) for x in ids] == texts


def test_encode_table(spark, model, reference_encoding):
    rows = [(1, "<|endoftext|> it's 中文　x"), (2, None), (3, ""), (4, "病" * 5000 + " a" * 3000), (1, "again")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("ids", F.lit("clash"))
    got = sorted((r.doc_id, list(r.ids)) for r in tokenize.encode_table(df, "doc_id", "text").collect())
    assert got == sorted((k, reference_encoding.encode_ordinary(t) if t else []) for k, t in rows)
    assert tokenize.encode_table(df.limit(0), "doc_id", "text").collect() == []


# p9


def test_leaks_against_brute_force(spark):
    rng = random.Random(11)
    items = [(i, words(rng, 20) + "Ab12" + words(rng, 20)) for i in range(12)] + [(99, "short item"), (98, None), (3, None)]
    docs = [(100, None), (101, ""), (102, words(rng, 5000))]
    for d in range(60):
        i, t = rng.choice(items[:12])
        n = rng.choice([29, 30, 31, len(t)])
        piece = t[:n]
        reworked = "".join(c + rng.choice(["", "", "　", "、", "\n", "​"]) for c in piece).replace("Ab12", "ａB１2")
        docs.append((d, words(rng, 40) + "。" + reworked + words(rng, 3)))
    fold = lambda t: leakage.normalise(t)[0]
    grams = defaultdict(set)
    for i, t in items:
        for k in range(len(fold(t or "")) - 29):
            grams[fold(t)[k : k + 30]].add(i)
    want = {(d, i) for d, t in docs for k in range(len(fold(t or "")) - 29) for i in grams.get(fold(t)[k : k + 30], ())}
    ddf = spark.createDataFrame(docs, "doc_id long, text string").withColumn("item_id", F.lit(0))
    idf = spark.createDataFrame(items, "item_id long, text string")
    kw = dict(doc_key="doc_id", doc_text="text", item_key="item_id", item_text="text")
    got = leakage.find_leaks(ddf, idf, **kw).collect()
    assert {(r[0], r[1]) for r in got} == want and want
    texts = dict(docs)
    for r in got:
        for s in r.spans:
            assert len(fold(texts[r[0]][s.start : s.end])) >= 30
    assert leakage.find_leaks(ddf, idf.limit(0), **kw).collect() == []
    assert leakage.find_leaks(ddf.limit(0), idf, **kw).collect() == []


def test_leaks_in_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(leakage, "BLOCK_CHARACTERS", 50)
    items = spark.createDataFrame([(1, string.ascii_letters), (2, string.ascii_lowercase * 2)], "i long, t string")
    docs = spark.createDataFrame([("d", string.ascii_uppercase * 2)], "d string, t string")
    assert sorted(r.i for r in leakage.find_leaks(docs, items, doc_key="d", doc_text="t", item_key="i", item_text="t").collect()) == [1, 2]


def test_short_items_leak_as_wholes(spark):
    items = spark.createDataFrame([(1, "Forty-Two apples"), (2, "a b"), (3, "…")], "i int, t string")
    docs = spark.createDataFrame([("d", "they ate FORTY two, ａpples!"), ("e", "forty-two pears"), ("f", "cab")], "d string, t string")
    kw = dict(doc_key="d", doc_text="t", item_key="i", item_text="t")
    got = {(r.d, r.i, r.covered) for r in leakage.find_leaks(docs, items, short=True, **kw).collect()}
    assert got == {("d", 1, 17), ("f", 2, 2)}
    assert leakage.find_leaks(docs, items, **kw).collect() == []


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="ab", max_size=24), min_size=1, max_size=4), st.text(alphabet="ab", max_size=40), st.integers(1, 9))
def test_passages_of_any_length_against_brute_force(items, text, length):
    found = leakage.Items(list(enumerate(items)), length, False).scan(text)
    want = {}
    for number, item in enumerate(items):
        covered = {p for i in range(len(text) - length + 1) if text[i : i + length] in item for p in range(i, i + length)}
        if covered:
            want[number] = covered
    assert {n: {p for a, b in spans for p in range(a, b)} for n, spans in found.items()} == want


def test_automaton_of_many_items_is_small():
    # Two million characters of items in one worker: memory is measured in a process of its own.
    code = """
import random, resource, sys
from palimpsest.llm import leakage
rng = random.Random(3)
letters = [chr(0x4E00 + i) for i in range(3000)]
items = [(i, "".join(rng.choices(letters, k=1000))) for i in range(2000)]
before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
own = leakage.Items(items, 30, False)
assert list(own.scan("x" * 50 + items[7][1][13:60] + "y" * 50)) == [7]
print((resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) * 1024 / 2_000_000)
"""
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True)
    assert float(out.stdout) < 150


# p10

ENDINGS = [
    ("完整的句子。", "finished"), ("完整的句子。 \n", "finished"), ("句子！", "finished"), ("A sentence.", "finished"), ("句子（93/2/4）。", "finished"), ("句子。（完）", "finished"),
    ("句子。\n－完－", "finished"), ("A sentence. (end)", "finished"), ("句子。\n承辦：整形外科", "label"), ("Text.\nContact: review desk 60", "label"),
    ("句子。\n中華民國112年8月27日", "finished"), ("Text.\n22 December 2025", "finished"), ("句子。\n8. 沛立瑞膜衣錠 99 mg", "entry"), ("達莎可乳膏公告附表", "title"),
    ("Index of brabarodron items", "title"), ("句子。」", "finished"), ("句子。…", "finished"), ("Text.\n2024-01-05 10:00", "finished"),
    ("逾76天；服凡倫克每35週複查轉胺酶，", "sentence"), ("申請cenodiglip…", "title"), ("含Gagamide varipar<br", "title"), ("服用，伏諾循療程中，體表&nb", "sentence"), ("必要時減半（", "title"),
    ("不得與\ufffd", "title"), ("無效（92/6/", "title"), ("it grew, not combined with Tilegan, vedacep", "sentence"), ("句子。\n經放射腫瘤科診斷為家族性心臟", "line"), ("轉由復健科處理。\n\n12.13.2", "line"),
    ("句子。\n3.8.16所列kaca 8 mg/k", "line"), ("句子。再次申請時", "sentence"), ("It ended. Then the", "sentence"), ("會議紀錄總結報告", "title"), ("Quarterly Performance Report", "title"), ("第一章 緒論", "title"),
    ("Chapter 3", "title"), ("SELECT a, b FROM t;", "other"), ("https://example.com/path", "other"), ("| a | b, c, d |", "other"), ("See you tomorrow :)", "title"), ("句。\n（三）附表", "entry"), ("Best wishes,\nAnna", "line"), ("謝謝大家", "title"),
    ("", None), (None, None), (" \n　\u200b", None),
]


def test_endings(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(ENDINGS)], "i int, t string").repartition(1)
    got = {r.i: r.e for r in df.select("i", truncation.ending_shape(F.col("t"))["shape"].alias("e")).collect()}
    assert [(ENDINGS[i][0], got[i]) for i in sorted(got)] == ENDINGS


def test_complete_endings_are_not_flagged(spark):
    rng = random.Random(19)
    ends = ["會議紀錄總結報告", "Quarterly Performance Report", "第一章 緒論", "Chapter 3", "SELECT * FROM t;", "See you tomorrow :)", "Best wishes,\nAnna", "2024-01-05 10:00", "https://example.com/path", "| a | b, c, d |", "謝謝大家"]
    texts = ["主治醫師" + words(rng, rng.randrange(20, 300)) + "。" for _ in range(300)] + ends + ["段落。\n" + e for e in ends]
    left = ["主治醫師" + words(rng, 9), "主治醫師" + words(rng, 30), "句子。主治", "段落。\n主治醫師" + words(rng, 3)]
    df = spark.createDataFrame([(i, t, "s") for i, t in enumerate(texts + left)], "doc_id long, text string, source string")
    found, _ = truncation.find_truncated(df, key="doc_id", text="text", source="source")
    got = {r.doc_id: r.cut_by for r in found.where("truncated").collect()}
    # A single bare line may be a title; behind other lines it is the start of a sentence, as lines that begin like it show.
    assert got == {len(texts) + 2: "transfer", len(texts) + 3: "transfer"}


def test_length_limits_are_found(spark):
    rng = random.Random(13)
    rows = []
    for source in ("limited", "free", None):
        for _ in range(400):
            text = words(rng, rng.randrange(50, 600)) + "。"
            rows.append((len(rows), source, text[:255] if source == "limited" else text))
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    found, limits = truncation.find_truncated(df, key="doc_id", text="text", source="source")
    got = {(r.source, r.unit, r.length) for r in limits.collect()}
    assert ("limited", "chars", 255) in got and all(s == "limited" for s, _, _ in got)
    cut = {r.doc_id for r in found.where("truncated").collect()}
    assert cut == {i for i, _, t in rows if not t.endswith("。")}
    assert {r.cut_by for r in found.where("truncated").collect()} == {"limit"}
    empty, none = truncation.find_truncated(df.limit(0), key="doc_id", text="text", source="source")
    assert empty.collect() == [] and none.collect() == []


def test_the_lengths_decide(spark, monkeypatch):
    # Bare lines and titles of 40 characters say nothing by themselves: without the length test none is found.
    rng = random.Random(23)
    texts = [words(rng, rng.randrange(10, 300)) + "。" for _ in range(400)]
    cut = [words(rng, 40) for _ in range(30)] + ["段落。\n甲乙" + words(rng, 34) for _ in range(30)]
    df = spark.createDataFrame([(i, t, "s") for i, t in enumerate(texts + cut)], "doc_id long, text string, source string")
    flagged = lambda: {r.doc_id for r in truncation.find_truncated(df, key="doc_id", text="text", source="source")[0].where("truncated").collect()}
    assert flagged() == set(range(400, 460))
    monkeypatch.setattr(truncation, "FALSE_DISCOVERIES", 1e-300)
    assert flagged() == set()


def test_endings_behind_long_ornaments(spark):
    body = "句子，不得，" * 100
    behind = ["…" * 400, "<br>" * 3000, "&nbsp;" * 200, "." * 401, "★ <span class='x'>" * 60, "</p>\n" * 67 + "..." * 150, f"<span class='{'x' * 500}'>", "<a href='" + "y" * 90]
    rows = [(f"{body}。{b}", "finished") for b in behind] + [(f"{body}{b}", "sentence") for b in behind] + [("★" * 399, "finished"), ("★" * 1500, "finished"), (f"短。{'★' * 900}", "finished")]
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(rows)], "i int, t string").repartition(1)
    got = {r.i: r.e for r in df.select("i", truncation.ending_shape(F.col("t"))["shape"].alias("e")).collect()}
    assert [got[i] for i in range(len(rows))] == [e for _, e in rows]


def test_lengths_decide_list_entries_and_headings(spark):
    rng = random.Random(17)
    # A source cuts at 255 and 40 characters, some inside a list entry or behind a word of headings.
    # The others have whole entries and headings, of like lengths, and no limit.
    ends = [words(rng, rng.randrange(10, 600)) + "。" for _ in range(600)]
    cut = ["句" * 255] * 60 + ["句" * 40] * 60 + ["句" * 244 + "\n8. 膜衣錠 8 m", "某" * 36 + "給付規定"]
    rows = [("cut", t) for t in ends + cut] + [("whole", t) for t in ends + ["句。\n8. 沛立瑞膜衣錠 99 mg"] * 60 + ["達莎可乳膏公告附表"] * 60]
    assert {len(t) for t in cut} == {255, 40}
    df = spark.createDataFrame([(i, s, t) for i, (s, t) in enumerate(rows)], "doc_id long, source string, text string")
    found, limits = truncation.find_truncated(df, key="doc_id", text="text", source="source")
    got = {r.doc_id for r in found.where("truncated").collect()}
    assert got == {i for i, (s, t) in enumerate(rows) if s == "cut" and t in cut}
    assert {(r.source, r.length) for r in limits.where("unit = 'chars'").collect()} == {("cut", 40), ("cut", 255)}


def test_lengths_are_tested_by_their_hazard(spark):
    # Half of those at risk stop at every length from 100 on: their numbers fall steeply, their hazards are equal.
    # At 200 and more few are left: 40 of 60 stop at 205, where one in ten does around it.
    steep = [("steep", 100 + 4 * k, 2048 >> k) for k in range(11)]
    late = [("late", 190 + k, 1000 if k < 11 else 40 if k == 15 else 1) for k in range(31)]
    rows = [(s, length) for s, length, n in steep + late for _ in range(n)]
    df = spark.createDataFrame(rows, "source string, chars long").withColumn("bytes", F.col("chars"))
    got = {(r.source, r.length): r for r in truncation.significant_lengths(df).where("unit = 'chars'").collect()}
    assert ("late", 205) in got and not [k for k in got if k[0] == "steep"]
    risk = lambda at: sum(1 for s, length in rows if s == "late" and length >= at)
    near = [length for length in range(190, 221) if abs(length - 205) > truncation.NEAREST and abs(length - 205) <= truncation.NEIGHBOURS]
    stopped = sum(1 for s, length in rows if s == "late" and length in near)
    expected = (stopped + 0.5) / sum(risk(length) for length in near) * risk(205)
    assert got["late", 205].expected == pytest.approx(expected) and got["late", 205].hazard == 40 / risk(205)
