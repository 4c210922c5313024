"""The commands one after another on drawn scans and a table of word boxes."""

import hashlib
import json

import numpy as np
import pytest

from quirework.cli import main
from quirework.sinks import png
from quirework.sources import files as source


@pytest.fixture
def book(tmp_path):
    scans = tmp_path / "scans"
    scans.mkdir()
    for n in (1, 2, 10):
        pixels = np.full((700, 1000, 3), 255, np.uint8)
        if n != 10:
            pixels[195:225, 100:300] = (255, 255, 0)
        (scans / f"p_{n}.PNG").write_bytes(png.encode(pixels))
    (scans / "notes.txt").write_text("x")
    (tmp_path / "book.yaml").write_text("book_id: b1\nscans_path: scans\ntitle: A Title\ntags: [t]\nextra: {k: 1}\n")
    rows = ["page_num\ttext\tconf\tleft\ttop\twidth\theight"]
    for page in (1, 2, 3):
        rows.append(f"{page}\t{page * 11}\t95\t900\t20\t40\t20")
        for k in range(6):
            for j, w in enumerate(f"Line {k} has wor-".split() if k == 3 else ["ds", "and", "more."] if k == 4 else f"Line {k} is here.".split()):
                rows.append(f"{page}\t{w}\t90\t{100 + 60 * j}\t{120 + 40 * k}\t50\t20")
        rows.append(f"{page}\t \t90\t1\t1\t5\t5")
    (tmp_path / "words.tsv").write_text("\n".join(rows) + "\n")
    return tmp_path


def run(book, command, *more):
    where = {"ocr": ["--out", "corpus", "--runs", "runs", "--words", "words.tsv"], "detect-highlights": ["--runs", "runs"], "make-spans": ["--runs", "runs", "--corpus", "corpus"], "emit-obsidian": ["--runs", "runs", "--corpus", "corpus"], "export-book-text": ["--out", "corpus"]}[command]
    paths = [str(book / w) if not w.startswith("--") else w for w in where]
    return main([command, "--book", str(book / "book.yaml"), *paths, *more])


def test_chain(spark, book):
    assert run(book, "ocr", "--run-id", "r1", "--dry-run") == 0 and not (book / "corpus").exists()
    assert run(book, "ocr", "--run-id", "r1") == 0
    corpus = book / "corpus/books/b1/pages.jsonl"
    pages = [json.loads(x) for x in corpus.read_text().splitlines()]
    assert [p["page_num"] for p in pages] == [1, 2, 3] and [p["printed_page"] for p in pages] == [11, 22, 33]
    assert pages[0]["scan_relpath"] == "p_1.PNG" and pages[0]["lines"][4]["text"] == "Line 3 has wor-"
    assert (book / "runs/r1/book_b1/page_0001/page_text.json").exists()
    assert run(book, "ocr", "--run-id", "r1") == 4
    assert run(book, "ocr", "--run-id", "r1", "--overwrite", "always") == 0
    assert run(book, "detect-highlights", "--run-id", "r1") == 0
    found = json.loads((book / "runs/r1/book_b1/page_0001/highlight_candidates.json").read_text())
    assert [c["bbox"] for c in found["candidates"]] == [[100, 195, 300, 225]] and found["config"]["kernel_size"] == 5
    assert all((book / f"runs/r1/book_b1/page_0002/{n}.png").read_bytes()[:4] == b"\x89PNG" for n in ("page_overlay", "highlights_overlay", "highlight_mask"))
    assert run(book, "make-spans") == 0
    spans = json.loads((book / "runs/r1/book_b1/page_0001/spans.json").read_text())
    assert spans["spans"][0]["span_id"] == "p1_s1" and len(spans["spans"][0]["line_ids"]) == 5
    assert json.loads((book / "runs/r1/book_b1/page_0003/spans.json").read_text())["spans"] == []
    assert (book / "runs/r1/book_b1/page_0001/spans_overlay.png").exists()
    assert run(book, "emit-obsidian") == 0
    notes = sorted(p.name for p in (book / "runs/r1/obsidian_staging/b1").iterdir())
    assert notes == ["b1_p1_s1.md", "b1_p1_s1.span.json", "b1_p2_s1.md", "b1_p2_s1.span.json"]
    assert '\n  - "literature_review"\n' in (book / "runs/r1/obsidian_staging/b1/b1_p1_s1.md").read_text()
    assert (book / "runs/r1/obsidian_staging/b1/b1_p1_s1.span.json").read_text().startswith('{\n  "book_id": "b1",\n  "page_num": 1,\n  "span_id": "p1_s1",\n  "line_ids": [\n    "p1_l')
    note = (book / "runs/r1/obsidian_staging/b1/b1_p1_s1.md").read_text()
    assert 'title: "A Title p1 p1_s1"' in note and "- printed_page: 11 (arabic)" in note
    assert json.loads((book / "runs/r1/obsidian_staging/b1/b1_p1_s1.span.json").read_text())["printed_page"] == "11"
    assert run(book, "export-book-text") == 0
    text = (book / "corpus/books/b1/book.txt").read_text()
    assert text.startswith("# Page 1\n11\n\nLine 0 is here.") and "Line 3 has words and more." in text and text.endswith(".\n")
    assert run(book, "export-book-text") == 4
    assert run(book, "export-book-text", "--format", "md", "--no-clean-text") == 0
    md = (book / "corpus/books/b1/book.md").read_text()
    assert md.startswith("# A Title\n\n\n\n## Page 11 (scan: p_1.PNG)\n\n11\nLine 0 is here.") and md.endswith("---\n")


def test_debug_block_and_dry_run(spark, book, capsys):
    assert run(book, "ocr", "--run-id", "r2", "--dry-run") == 0
    said = capsys.readouterr().out
    assert f"[dry-run] write json: {book}/runs/r2/book_b1/page_0001/page_text.json" in said and f"[dry-run] write image: {book}/runs/r2/book_b1/page_0003/page_overlay.png" in said
    assert f"[dry-run] write jsonl: {book}/corpus/books/b1/pages.jsonl" in said and not (book / "runs").exists()
    assert run(book, "ocr", "--run-id", "r2", "--printed-page-debug") == 0
    page = json.loads((book / "runs/r2/book_b1/page_0002/page_text.json").read_text())
    tried = page["printed_page_debug"]
    assert tried["mode"] == "arabic" and tried["result"] == {"printed_page": 22, "printed_page_text": "22", "printed_page_kind": "arabic"}
    best = tried["candidates"]
    assert best["selected_kind"] == "arabic" and best["selected"] == best["arabic_top_candidates"][0] and best["roman_top_candidates"] == []
    assert best["selected"] == {"text": "22", "conf": 95.0, "bbox": [900, 20, 940, 40], "x_center_norm": 0.92, "y_center_norm": 30 / 700, "source": "word", "line_id": None}
    assert len(best["arabic_top_candidates"]) == 2


def test_settings(book):
    from quirework.errors import ConfigError
    from quirework.sources import config

    own, settings, digest = config.load_book(book / "book.yaml")
    assert (own.book_id, own.scans_path, own.tags, own.metadata, own.vault_out_path) == ("b1", str(book / "scans"), ("t",), {"extra": {"k": 1}}, None)
    assert own.texts == {
        "title": "A Title", "creator": "", "year": "", "format": "book", "publisher_studio": "", "note_type": "literature_review", "note_status": "inbox", "note_version": "v0.1.3", "YAML_schema_version": "v0.1.2", "register": "public"
    }
    material = '{"book": {"book_id": "b1", "extra": {"k": 1}, "scans_path": "scans", "tags": ["t"], "title": "A Title"}, "pipeline": {"emit_obsidian": {"sidecar_json_default": true}, '
    material += '"highlights": {"hsv_high": [95, 255, 255], "hsv_low": [15, 20, 80], "kernel_size": 5, "min_area": 120}, "ocr": {"language": "eng", "line_y_tolerance_px": 14, "psm": 6}, "spans": {"k_after": 2, "k_before": 2}}}'
    assert digest == hashlib.sha256(material.encode()).hexdigest()[:16]
    (book / "p.yaml").write_text("ocr: {psm: 4}\nspans: 3\nqa: {min_alpha_ratio: 0.5}\n")
    laid = config.load_book(book / "book.yaml", book / "p.yaml")[1]
    assert laid["ocr"] == {"line_y_tolerance_px": 14, "language": "eng", "psm": 4} and laid["spans"] == 3 and laid["qa"] == {"min_alpha_ratio": 0.5}
    for text in ("scans_path: s", "book_id: x", "book_id: x\nscans_path: s\ntags: 3", "- a", "a: [", "book_id: ' '\nscans_path: s"):
        (book / "bad.yaml").write_text(text)
        with pytest.raises(ConfigError):
            config.load_book(book / "bad.yaml")
    (book / "short.yaml").write_text(f"book_id: b9\nscans_path: {book}/scans\nvault_out_path: out/v\n")
    own, _, digest = config.load_book(book / "short.yaml")
    assert own.vault_out_path == str(book / "out/v")


def test_hash_as_a_column(spark, book):
    from pyspark.sql import functions as F

    from quirework.sources import config

    (book / "short.yaml").write_text("book_id: b9\nscans_path: s/t\n")
    row = spark.createDataFrame([("b9", "s/t")], "a string, b string").select(config.hash_of(F.col("a"), F.col("b")).alias("h")).first()
    assert row.h == config.load_book(book / "short.yaml")[2]


def test_scan_paths(tmp_path):
    (tmp_path / "a+b.c").mkdir()
    (tmp_path / "a+b.c/p_1.png").write_bytes(b"")
    (tmp_path / "away.png").write_bytes(b"")
    assert source.relative(tmp_path / "a+b.c/p_1.png", tmp_path / "a+b.c") == "p_1.png" and source.relative(tmp_path / "away.png", tmp_path / "a+b.c") == "away.png"


def test_exit_codes(spark, book):
    assert main(["export-book-text", "--book", str(book / "none.yaml")]) == 3
    assert main(["make-spans", "--book", str(book / "book.yaml"), "--runs", str(book / "none")]) == 1
    assert main(["export-book-text", "--book", str(book / "book.yaml"), "--out", str(book / "none")]) == 1
    assert main(["ocr", "--book", str(book / "book.yaml")]) == 5
    (book / "bad.yaml").write_text("book_id: x\nscans_path: s\ntags: 3\n")
    assert main(["detect-highlights", "--book", str(book / "bad.yaml")]) == 3


def test_scans_in_natural_order(book):
    assert [p.name for p in source.discover_images(book / "scans")] == ["p_1.PNG", "p_2.PNG", "p_10.PNG"]
    assert len(source.first_pages([1, 2, 3], 2)) == 2 and len(source.first_pages([1, 2, 3], 0)) == len(source.first_pages([1, 2, 3], None)) == 3


def test_corpus_reader(spark, tmp_path):
    good = tmp_path / "a.jsonl"
    good.write_text('﻿{"book_id":"b","page_num":1}\n\n{"book_id":"b","page_num":2}\n', encoding="utf-8")
    assert sorted(r.page_num for r in source.read_pages(spark, good).collect()) == [1, 2]
    with pytest.raises(FileNotFoundError):
        source.read_pages(spark, tmp_path / "none")
    good.write_text('{"book_id":\n')
    with pytest.raises(Exception):  # noqa: B017
        source.read_pages(spark, good).collect()
