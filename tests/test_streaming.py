import json

from quirework.streaming import pages as P


def test_page_streams(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()

    def put(name, rows):
        (src / name).write_text("\n".join(json.dumps(r) for r in rows))

    def page(n, printed, kind="arabic"):
        return {"book_id": "b", "page_num": n, "printed_page": printed, "printed_page_kind": kind, "lines": [{"line_id": "l", "bbox": [0, 0, 1, 1], "words": [], "text": "Some plain words of text."}]}

    put("1.json", [page(9, 12), page(3, 2), page(1, 40, "roman")])
    stream = P.page_stream(spark, str(src))
    q1 = P.quality_stream(stream).writeStream.format("memory").queryName("quality").option("checkpointLocation", str(tmp_path / "c1")).start()
    q2 = P.first_arabic_stream(stream).writeStream.format("memory").queryName("switch").outputMode("update").option("checkpointLocation", str(tmp_path / "c2")).start()
    q1.processAllAvailable()
    q2.processAllAvailable()
    put("2.json", [page(5, 20), page(12, 30)])
    q1.processAllAvailable()
    q2.processAllAvailable()
    assert spark.table("quality").where("not low_quality").count() == 5
    assert [r.switch_page for r in spark.table("switch").collect()] == [9, 5]
    q1.stop()
    q2.stop()
