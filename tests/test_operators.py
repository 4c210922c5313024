"""Core operators on small vectors, and against plain Python where SQL cannot follow."""

import itertools
import json

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quirework.functions import text as X
from quirework.operators import highlights, lines, nested, notes, page_numbers, quality, render, spans
from quirework.operators.pages import latest, ordinal
from quirework.schema import LINE, WORD
from quirework.sinks import png

LINES = "array<struct<line_id:string,bbox:array<int>,words:array<struct<text:string,bbox:array<int>,confidence:double>>,text:string>>"


def word(text, conf=95.0, box=(0, 0, 0, 0)):
    return {"text": text, "bbox": list(box), "confidence": None if conf is None else float(conf)}


def line(words, line_id="l", box=None, text=None):
    boxes = [w["bbox"] for w in words]
    box = box or ([min(b[0] for b in boxes), min(b[1] for b in boxes), max(b[2] for b in boxes), max(b[3] for b in boxes)] if boxes else [0, 0, 0, 0])
    return {"line_id": line_id, "bbox": box, "words": words, "text": text if text is not None else " ".join(w["text"] for w in words)}


def one(spark, column, **values):
    schema = ", ".join(f"{k} {t}" for k, (t, _) in values.items())
    return spark.createDataFrame([tuple(v for _, v in values.values())], schema).select(column.alias("x")).first().x


# ---------------------------------------------------------------------------------------------------------- text
def test_roman(spark):
    rows = spark.createDataFrame([(t,) for t in ("xiv", "XXXV", "iix", "vx", "six", "", "mmmmcmxcix", None)], "t string").select(X.roman_value(F.col("t")).alias("v")).collect()
    assert [r.v for r in rows] == [14, 35, None, None, 9, None, 4999, None]
    assert one(spark, X.plausible_roman(F.col("t"), 2, 80), t=("string", "xiv"))
    assert not one(spark, X.plausible_roman(F.col("t"), 2, 80), t=("string", "m"))


def test_space_follows_python(spark):
    odd = "".join(map(chr, [0x1C, 0x85, 0xA0, 0x2003, 0x3000, 0x0B])) + "a b" + chr(0xA0)
    assert one(spark, X.strip(F.col("t")), t=("string", odd)) == odd.strip()
    assert one(spark, X.one_spaced(F.col("t")), t=("string", odd)) == " ".join(odd.split())


def test_fixed_rounds_binary_values(spark):
    values = [57.25, 0.35, 0.05, 99.95, 0.0, None]
    got = [r.x for r in spark.createDataFrame([(v,) for v in values], "v double").select(X.fixed(F.col("v"), 1).alias("x")).collect()]
    assert got == [None if v is None else f"{v:.1f}" for v in values]


def test_yaml_string_is_json(spark):
    for t in ("a", 'q"u\\o', "tab\tnl\n", "\x01\x7f", "日本 😀", ""):
        assert one(spark, X.yaml_string(F.col("t")), t=("string", t)) == json.dumps(t, ensure_ascii=False)
    assert one(spark, X.yaml_string(F.col("t")), t=("string", None)) == '""'


def test_file_name(spark):
    got = [one(spark, X.file_name(F.col("t")), t=("string", t)) for t in ("a b/c", "..x_", "", "é", "A-1.b")]
    assert got == ["a_b_c", "x", "note", "note", "A-1.b"]


def test_ordinal_is_natural_and_global(spark):
    names = ["p_2.png", "p_10.png", "P_1.png", "p_03.png", "q.png"]
    df = spark.createDataFrame([("b", n) for n in names] + [("c", n) for n in names[:2]], "book_id string, name string")
    rows = {(r.book_id, r.name): r.ordinal for r in ordinal(df, "book_id", X.natural_key(F.col("name")), "name").collect()}
    assert [k[1] for k in sorted((k for k in rows if k[0] == "b"), key=rows.get)] == ["P_1.png", "p_2.png", "p_03.png", "p_10.png", "q.png"]
    assert rows["c", "p_10.png"] == 2


def test_ordinal_of_a_hot_group(spark):
    df = spark.range(2000).select(F.when(F.col("id") % 3 == 0, "x").otherwise("hot").alias("g"), F.col("id"))
    rows = ordinal(df, "g", "id").groupBy("g").agg(F.count("*").alias("n"), F.max("ordinal").alias("m"), F.count_distinct("ordinal").alias("d")).collect()
    assert all(r.n == r.m == r.d for r in rows)


# ---------------------------------------------------------------------------------------------------------- render
def test_render_vectors(spark):
    def text(ls):
        return one(spark, render.rendered(F.col("l")), l=(LINES, ls))

    noisy = [line([word("|", 90)]), line([word("a", 95)]), line([word("i", 40)]), line([word("hello", 95), word("world", 95)])]
    assert text(noisy) == "a hello world"
    assert text([line([word("con-", 90)]), line([word("demned"), word("in"), word("Geneva.")])]) == "condemned in Geneva."
    assert text([line([], text="This is a line"), line([], text="continued with lowercase")]) == "This is a line continued with lowercase"
    assert text([]) == "" and text(None) == "" and text([None, line([], text="x y")]) == "x y"


def _merge(ls):
    import re

    out, i = [], 0
    while i < len(ls):
        if i + 1 < len(ls) and re.search(r"-\s*[)\]}\"'`.:;,_!]*\Z", ls[i]) and re.match("[a-z]", ls[i + 1]):
            out.append(" ".join((re.sub(r"-\s*[)\]}\"'`.:;,_!]*\Z", "", ls[i]).rstrip() + ls[i + 1]).split()))
            i += 2
        else:
            out.append(ls[i])
            i += 1
    return out


def _blocks(ls):
    import re

    out = []
    for t in ls:
        if out and not re.match(r"(?:\d{3,4}\s|[-*•]\s)", out[-1]) and not re.match(r"(?:\d{3,4}\s|[-*•]\s)", t) and not re.search(r"[.!?][\"')\]]*\Z", out[-1]) and re.match("[a-z]", t):
            out[-1] += " " + t
        else:
            out.append(t)
    return out


def test_folds_against_plain_loops(spark):
    kinds = ["con-", "abc", "Abc.", "123", "* it", "dem-."]
    cases = [list(c) for n in range(1, 5) for c in itertools.product(kinds, repeat=n)]
    df = spark.createDataFrame([(c,) for c in cases], "t array<string>")
    for r in df.select("t", render.merge_hyphens(F.col("t")).alias("m"), render.paragraphs(F.col("t")).alias("p")).collect():
        assert r.m == _merge(r.t)
        assert r.p == _blocks(r.t)


# ---------------------------------------------------------------------------------------------------------- quality
def test_quality_rules(spark):
    def low(**m):
        base = {"char_count": 100, "line_count": 5, "avg_word_conf": 90.0, "alpha_ratio": 0.9, "garbage_ratio": 0.0, "pipe_ratio": 0.0} | m
        kind = "struct<char_count:bigint,line_count:bigint,avg_word_conf:double,alpha_ratio:double,garbage_ratio:double,pipe_ratio:double>"
        return one(spark, quality.low_quality(F.col("m")), m=(kind, base))

    assert not low()
    assert low(line_count=0) and low(char_count=0)
    assert low(char_count=11, alpha_ratio=0.34) and not low(char_count=12, alpha_ratio=0.46)
    assert low(pipe_ratio=0.041, alpha_ratio=0.44) and not low(pipe_ratio=0.04, alpha_ratio=0.44)
    assert low(garbage_ratio=0.23, alpha_ratio=0.44) and not low(garbage_ratio=0.22, alpha_ratio=0.44)
    assert low(avg_word_conf=57.9, garbage_ratio=0.17) and not low(avg_word_conf=58.0, garbage_ratio=0.17) and not low(avg_word_conf=None, garbage_ratio=0.17)


def test_metrics_of_nothing(spark):
    for ls in (None, [], [None], [line([], text="  ")], [line([word(None, None, (0, 0, 1, 1))], text="x")]):
        m = one(spark, quality.metrics(F.col("l")), l=(LINES, ls))
        assert (m.char_count, m.line_count, m.avg_word_conf, m.alpha_ratio) == (0, 0, None, 0.0)


def test_thresholds():
    assert quality.Thresholds.of({"qa": {"min_alpha_ratio": "0.5", "max_pipe_ratio": "x"}}) == quality.Thresholds(min_alpha_ratio=0.5)
    assert quality.Thresholds.of(None) == quality.Thresholds.of({"qa": 3}) == quality.Thresholds()


# ---------------------------------------------------------------------------------------------------------- page numbers
def detect(spark, words, scan="p.png", width=1000, height=1400, ls=None):
    ls = ls if ls is not None else [line(words, "p1_l1")]
    schema = f"words array<{WORD.simpleString()}>, lines array<{LINE.simpleString()}>, page_width int, page_height int, scan_relpath string"
    df = spark.createDataFrame([(words, ls, width, height, scan)], schema)
    r = page_numbers.detected(df, X.scan_side(F.col("scan_relpath"))).first()
    return r.found_page, r.found_text, r.found_kind


def test_page_number_vectors(spark):
    assert detect(spark, [word("Introduction", 92, (180, 20, 360, 56)), word("xiv", 89, (930, 20, 980, 56))]) == (14, "xiv", "roman")
    assert detect(spark, [word("Chronology", 93, (200, 20, 400, 60)), word("...", 88, (420, 22, 460, 60)), word("XXXV", 91, (910, 24, 980, 60))]) == (35, "XXXV", "roman")
    assert detect(spark, [word("122", 95, (940, 20, 990, 52))], "x_R.png", height=1200) == (122, "122", "arabic")
    assert detect(spark, [word("m", 99, (960, 30, 990, 60))]) == (None, None, None)
    assert detect(spark, [], ls=[]) == (None, None, None)
    assert detect(spark, None, ls=[{"line_id": None, "bbox": None, "words": None, "text": None}, None]) == (None, None, None)
    two = [word("14", 90, (40, 20, 90, 52)), word("15", 90, (900, 20, 950, 52))]
    assert detect(spark, two, "a_L.png", ls=[])[0] == 14 and detect(spark, two, "a_R.png", ls=[])[0] == 15


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.sampled_from([("arabic", 12), ("arabic", 3), ("roman", 14), (None, None)]), max_size=8))
def test_switch_against_a_loop(spark, pages):
    rows = [("b", i, v, str(v) if v else None, k) for i, (k, v) in enumerate(pages)]
    df = spark.createDataFrame(rows, "book_id string, page_num int, found_page int, found_text string, found_kind string")
    got = [(r.found_page, r.found_kind, r.mode) for r in page_numbers.switched(df).orderBy("page_num").collect()]
    want, mode = [], "auto"
    for k, v in pages:
        gone = mode == "arabic" and k == "roman"
        if k == "arabic" and v >= 10:
            mode = "arabic"
        want.append((None if gone else v, None if gone else k, mode))
    assert got == want


# ---------------------------------------------------------------------------------------------------------- lines
def test_line_grouping_follows_the_running_mean(spark):
    words = [word(str(i), 90, (i * 10, y, i * 10 + 8, y + 10)) for i, y in enumerate((0, 10, 20, 30))]
    df = spark.createDataFrame([(1, 7, words), (2, 1, []), (3, 1, None), (4, 1, [None, word("x", 1, ())])], f"k int, page_num int, words array<{WORD.simpleString()}>")
    rows = {r.k: r.lines for r in lines.grouped_lines(df, "k").collect()}
    assert [x.text for x in rows[1]] == ["0 1", "2 3"] and rows[1][0].line_id == "p7_l1" and rows[1][1].bbox == [20, 20, 38, 40]
    assert rows[2] == rows[3] == rows[4] == []


def test_usable_words(spark):
    rows = [("a", "96", 1, 1, 5, 5), (" ", "96", 1, 1, 5, 5), ("b", "-1", 1, 1, 5, 5), ("c", "x", 1, 1, 5, 5), ("d", "0", 1, 1, 0, 5), (None, "3", 1, 1, 1, 1)]
    df = spark.createDataFrame(rows, "text string, conf string, left int, top int, width int, height int")
    assert [r.text for r in lines.usable_words(df).collect()] == ["a"]


# ---------------------------------------------------------------------------------------------------------- spans
def test_vertical_stripe_takes_the_nearest_line(spark):
    ls = [line([], f"l{i}", [100, 10 + 30 * i, 500, 30 + 30 * i], "t") for i in range(5)]
    assert one(spark, spans.selected_lines(F.col("l"), F.array(*map(F.lit, (0, 0, 12, 200)))), l=(LINES, ls)) == [3]
    many = [line([], f"l{i}", [100, 10 * i, 500, 10 * i + 8], "t") for i in range(20)]
    assert one(spark, spans.selected_lines(F.col("l"), F.array(*map(F.lit, (100, 0, 500, 200)))), l=(LINES, many)) == [10]  # middle 104 is nearest to 100


def test_shape(spark):
    def ok(*box):
        v = [F.lit(x) for x in (1000, 1400, 25, 3.0, 0.15)]
        return one(spark, spans.shape_ok(F.array(*map(F.lit, box)), *v), x=("int", 1))

    assert not ok(2, 10, 12, 450)
    assert ok(200, 300, 500, 350)


def test_equal_windows_merge(spark):
    ls = [line([], f"l{i}", [0, 20 * i, 400, 20 * i + 15], "t") for i in range(3)]
    pages = spark.createDataFrame([("b", 1, ls), ("b", 2, [])], f"book_id string, page_num int, lines {LINES}")
    c = [{"bbox": [0, 0, 100, 10], "area": 1, "color_stats": None}, {"bbox": [0, 20, 100, 30], "area": 1, "color_stats": None}]
    kind = "array<struct<bbox:array<int>,area:int,color_stats:struct<h_mean:double,s_mean:double,v_mean:double>>>"
    cand = spark.createDataFrame([("r", "b", 1, c), ("r", "b", 2, c), ("r", "b", 3, c), ("r", "b", 1, [])], f"run_id string, book_id string, page_num int, candidates {kind}")
    r = spans.page_spans(cand, pages).collect()
    assert len(r) == 1 and r[0].span_id == "p1_s1" and r[0].line_ids == ["l0", "l1", "l2"] and len(r[0].trigger_bboxes) == 2 and r[0].span_bbox == [0, 0, 400, 55]


def test_latest_record_wins(spark):
    df = spark.createDataFrame([(1, "b", 1, "2024-01-02"), (2, "b", 1, "2024-01-01"), (3, "b", 2, None), (4, "b", 2, None)], "record_id bigint, book_id string, page_num int, t string").withColumn("ingested_at", F.col("t").cast("timestamp_ntz"))
    assert sorted(r.record_id for r in latest(df).collect()) == [1, 4]


# ---------------------------------------------------------------------------------------------------------- notes
def test_notes(spark):
    ls = [line([word("Hello"), word("there.")], "a"), line([word("twice")], "d"), line([word("Again"), word("here.")], "d")]
    pages = spark.createDataFrame([("b", 1, ls, "s/p.png", ("h",), 3, "iii", "roman")], f"book_id string, page_num int, lines {LINES}, scan_relpath string, config struct<config_hash:string>, printed_page int, printed_page_text string, printed_page_kind string")
    cols = "title creator year format publisher_studio note_type note_status note_version yaml_schema_version register".split()
    books = spark.createDataFrame([("b", *['T "x"', None, *["v"] * 8], ["t1", "book/b", None])], "book_id string, " + ", ".join(f"{c} string" for c in cols) + ", tags array<string>")
    sp = spark.createDataFrame([("r", "b", 1, "p1_s1", ["d", "zz", "a"], [[1, 2, 3, 4]], [0, 0, 1, 1]), ("r", "b", 1, "p1_s2", ["zz"], [], None)], "run_id string, book_id string, page_num int, span_id string, line_ids array<string>, trigger_bboxes array<array<int>>, span_bbox array<int>")
    rows = {r.span_id: r for r in notes.checked(notes.notes(sp, pages, books)).collect()}
    assert rows["p1_s1"].quote == "Again here.\n\nHello there." and rows["p1_s2"].quote.startswith("OCR LOW QUALITY (avg_conf=n/a, garbage=0.000)")
    assert rows["p1_s1"].tags == ["book/b", "ingest/highlight_excerpt", "t1"] and "- printed_page: iii (roman)" in rows["p1_s1"].note
    assert 'title: "T \\"x\\" p1 p1_s1"' in rows["p1_s1"].note
    bad = notes.notes(sp, pages, books, notes.TEMPLATE.replace("creator:", "maker:"))
    with pytest.raises(Exception, match="not allowed: maker"):
        notes.checked(bad).collect()


# ---------------------------------------------------------------------------------------------------------- highlights
def test_components_against_flood_fill():
    rng = np.random.default_rng(1)
    for _ in range(30):
        mask = rng.random((12, 15)) < 0.4
        labels = highlights.components(mask)
        want = np.zeros(mask.shape, int)
        n = 0
        for y, x in zip(*np.nonzero(mask), strict=True):
            if want[y, x]:
                continue
            n += 1
            todo = [(y, x)]
            while todo:
                a, b = todo.pop()
                if 0 <= a < 12 and 0 <= b < 15 and mask[a, b] and not want[a, b]:
                    want[a, b] = n
                    todo += [(a + i, b + j) for i in (-1, 0, 1) for j in (-1, 0, 1)]
        assert (labels == want).all()


def test_highlight_of_a_drawn_mark():
    pixels = np.full((400, 600, 3), 255, np.uint8)
    pixels[100:130, 200:400] = (0, 255, 255)  # yellow in BGR
    found = highlights.marks(pixels.tobytes(), 400, 600, 3)
    assert [(c["bbox"], c["area"]) for c in found] == [([200, 100, 400, 130], 6000)]
    assert found[0]["color_stats"] == {"h_mean": 30.0, "s_mean": 255.0, "v_mean": 255.0}
    assert highlights.marks(np.zeros((20, 20), np.uint8).tobytes(), 20, 20, 1) == []


def test_png_is_decoded_again(spark, tmp_path):
    pixels = np.arange(30 * 20 * 3, dtype=np.uint8).reshape(20, 30, 3)
    (tmp_path / "a.png").write_bytes(png.encode(png.boxed(pixels, [[1, 1, 9, 9]], (1, 2, 3))))
    r = spark.read.format("image").load(str(tmp_path)).select("image.*").first()
    assert (r.height, r.width) == (20, 30)
    assert (png.rgb(bytes(r.data), 20, 30, r.nChannels)[1, 1] == (1, 2, 3)).all()


# ---------------------------------------------------------------------------------------------------------- nested
PAYLOADS = [
    (1, json.dumps({"page_num": 1, "lines": [{"words": [{"text": "a"}, None, {"text": "b"}]}, None, {"words": None}, {"text": "t", "words": []}], "words": [{"text": "z"}, None]})),
    (2, "﻿" + json.dumps({"pages": [{"page_num": 1, "lines": json.dumps([{"words": [{"text": "a"}]}])}, None, {"page_num": 2, "words": [{}]}]}) + " ;"),
    (3, json.dumps([{"page": {"page_num": 1, "lines": [{"words": [{"text": "x", "confidence": "12.5", "bbox": {"x1": 1, "y1": 2, "x2": 3, "y2": 4}}]}]}}])),
    (4, '{"page_num": 1, "lines": [{"words": [{"te'),
    (5, ""),
    (6, None),
    (7, "   "),
    (8, "null"),
    (1, json.dumps({"page_num": 1, "lines": [], "words": []})),
    (9, json.dumps({"page_num": 1, "lines": [{"words": [{"text": "w" * 200000}]}]})),
]


def test_page_positions(spark):
    df = spark.createDataFrame([(i, p, "x") for i, p in PAYLOADS], "raw_id bigint, payload string, rec_pos string")
    got = sorted(tuple(r) for r in nested.page_positions(df).collect())
    assert got == sorted(
        [(1, 0, 0, 0), (1, 0, 0, 2), (1, 0, 2, -1), (1, 0, 3, -1), (1, 0, -1, 0), (2, 0, 0, 0), (2, 2, -1, 0), (3, 0, 0, 0), (9, 0, 0, 0)]
    )
    layout = nested.infer_layout(df, "payload", nested.PAGE_FIELDS)
    assert layout.wrappers == ("page", "pages") and ("lines", "words") in layout.arrays and ("words",) in layout.arrays


def test_page_tables(spark):
    df = spark.createDataFrame(PAYLOADS, "raw_id bigint, payload string")
    t = nested.page_tables(df)
    r = t["words"].where("raw_id = 3").first()
    assert (r.text, r.x1, r.y2, r.confidence, r.line_pos) == ("x", 1, 4, 12.5, 0)
    assert t["records"].count() == 6 and t["lines"].where("raw_id = 1").count() == 3
    g = nested.flatten_json(df, "raw_id", "payload", nested.PAGE_FIELDS)
    assert g["lines.words"].where("raw_id = 1").count() == 2


def test_flatten_struct(spark):
    schema = "record_id int, line_pos string, lines array<struct<record_id:int,words:array<struct<text:string>>,tags:array<string>>>"
    df = spark.createDataFrame([(1, "x", [{"record_id": 7, "words": [{"text": "a"}, None], "tags": ["t"]}, None]), (2, None, None)], schema)
    t = nested.flatten_struct(df, "record_id")
    assert [c for c in t["lines"].columns] == ["record_id", "line_pos", "record_id_", "tags"]
    assert [tuple(r) for r in t["lines.words"].collect()] == [(1, 0, 0, "a")] and t["record"].count() == 2
    assert nested.flatten_struct(df.limit(0), "record_id")["lines.words"].count() == 0


def test_keys_that_are_data_are_refused(spark, monkeypatch):
    monkeypatch.setattr(nested, "MAX_PATHS", 20)
    df = spark.createDataFrame([(1, json.dumps({f"k{i}": i for i in range(50)}))], "raw_id int, payload string")
    with pytest.raises(ValueError, match="distinct paths"):
        nested.infer_layout(df, "payload", nested.PAGE_FIELDS)


def test_joined_lines_and_paragraphs_against_loops(spark):
    """Joined lines and paragraphs, over random pages of short lines, against loops that carry the state along."""
    import random
    import re

    from pyspark.sql import functions as F

    from quirework.operators import render

    rng = random.Random(4)
    bits = ["the end.", "a so-", "1896", "1896 x", "-", "- item", "small words", "Big words", "end”", 'said "no."', "re-\"", "b-", "12 a", "* x", "zo", "tail-)", "•"]
    rows = [(i, [rng.choice(bits) for _ in range(rng.randrange(12))]) for i in range(400)]

    def plain(lines):
        joined, i = [], 0
        while i < len(lines):
            if i + 1 < len(lines) and re.search(r"""-\s*[)\]}"'`.:;,_!]*\Z""", lines[i]) and re.match("[a-z]", lines[i + 1]):
                joined.append(" ".join((re.sub(r"""-\s*[)\]}"'`.:;,_!]*\Z""", "", lines[i]).rstrip() + lines[i + 1]).split()))
                i += 2
            else:
                joined.append(lines[i])
                i += 1
        blocks = joined[:1]
        for t in joined[1:]:
            item = re.compile(r"(?:[0-9]{3,4}\s|[-*•]\s)")
            if item.match(blocks[-1]) or item.match(t) or re.search(r"""[.!?]["')\]]*\Z""", blocks[-1]) or not re.match("[a-z]", t):
                blocks.append(t)
            else:
                blocks[-1] += " " + t
        return joined, blocks

    df = spark.createDataFrame(rows, "id int, lines array<string>")
    got = df.select("id", render.merge_hyphens(F.col("lines")).alias("joined"), render.paragraphs(render.merge_hyphens(F.col("lines"))).alias("blocks")).collect()
    for r in got:
        assert (r.joined, r.blocks) == plain(rows[r.id][1]), rows[r.id]


def test_latest_record_of_each_page(spark, monkeypatch):
    import datetime as dt

    from quirework.operators import pages

    t = dt.datetime(2024, 1, 1)
    rows = [(1, "b", 1, t), (2, "b", 1, t), (3, "b", 2, None), (4, "b", 2, t), (5, None, 1, None), (6, None, 1, None), (7, "b", None, t), (8, "c", 1, t), (8, "c", 1, t)]
    df = spark.createDataFrame(rows, "record_id int, book_id string, page_num int, ingested_at timestamp_ntz")
    for bound in (pages.MAX_OUTDATED, 0):
        monkeypatch.setattr(pages, "MAX_OUTDATED", bound)
        assert sorted(r.record_id for r in pages.latest(df).collect()) == [2, 4, 6, 7, 8, 8]
    assert pages.latest(df.limit(0)).count() == 0
