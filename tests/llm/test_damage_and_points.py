"""Damaged archives raise, hot payloads and repeated rows stay whole, points of the schedule stay apart at any size."""

import os

import pytest
from pyspark.errors import PythonException
from pyspark.sql import functions as F

from sluice.llm import mixing, suffix_dedup, warc
from sluice.llm.common import shared_folder


def archive(spark, rows):
    folder = shared_folder(spark, "warc-damage")
    manifest = warc.write_warc(spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1), folder)
    return folder, manifest, os.path.join(folder.removeprefix("file://"), manifest.first()["file"])


@pytest.mark.parametrize("split", [97, 1000, 8 << 20])
@pytest.mark.parametrize("damage", ["first header", "inside", "header", "trailer", "cut", "none"])
def test_damaged_archive(spark, split, damage):
    rows = [(i, f"http://a/{i}", f"<p>{i}</p>" * (1 + i * 7)) for i in range(12)]
    folder, manifest, path = archive(spark, rows)
    data = bytearray(open(path, "rb").read())
    starts, at = [], 0
    while at >= 0:
        starts.append(at)
        at = data.find(warc.MAGIC, at + 1)
    spot = {"first header": 1, "inside": starts[7] - 40, "header": starts[5] + 1, "trailer": starts[6] - 6, "cut": None, "none": None}[damage]
    if spot is not None:
        data[spot] ^= 0x5A
    if damage == "cut":
        data = data[:-5]
    with open(path, "wb") as f:
        f.write(data)
    crc = os.path.join(os.path.dirname(path), f".{os.path.basename(path)}.crc")
    assert not os.path.exists(crc)
    if damage == "none":
        assert {r.page_id for r in warc.read_warc(spark, manifest, folder, split=split).collect()} == set(range(12))
    else:
        with pytest.raises(PythonException):
            warc.read_warc(spark, manifest, folder, split=split).collect()


def test_hot_payload_and_empty_pages(spark):
    pages = spark.range(2000).select(F.col("id").alias("page_id"), F.lit("u").alias("url"),
                                     F.when(F.col("id") % 3 == 0, F.col("id").cast("string")).otherwise("same").alias("html"))
    got = warc.warc_digest(pages).collect()
    assert len(got) == 2000 and sum(r.record_type == "revisit" for r in got) == 1332
    assert {r.refers_to for r in got if r.record_type == "revisit"} == {1}
    assert warc.warc_digest(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_golden_points(spark):
    slots = [0, 1, 2, 12345, (1 << 31) - 1, 1 << 31, (1 << 38) + 5, (1 << 45) - 3]
    df = spark.createDataFrame([(s,) for s in slots], "slot long")
    got = {r.slot: r.p for r in df.select("slot", mixing.golden_point(F.col("slot")).alias("p")).collect()}
    assert got == {s: s * mixing.INVERSE_PHI % (1 << 62) for s in slots}
    assert abs(mixing.INVERSE_PHI / (1 << 62) - (5 ** 0.5 - 1) / 2) < 1e-15
    far = spark.range(1 << 38, (1 << 38) + 200_000).select(mixing.golden_point(F.col("id")).alias("p"))
    assert far.distinct().count() == 200_000
    # every stretch meets every part alike
    parts = far.groupBy(F.shiftright("p", 55)).count().agg(F.min("count"), F.max("count")).first()
    assert parts[1] - parts[0] <= 3


def test_repeated_rows_and_texts_of_a_doc_id(spark):
    words = [f"w{i}" for i in range(200)]
    shared = " ".join(words[:60])
    rows = [(1, shared + " tail one")] * 3 + [(1, "short")] + [(1, "x " * 60)] + [(2, "head " + shared)] + [(2, "")] + [(3, " ".join(words[100:190]))] + [(None, shared)]
    got = sorted(tuple(r[c] for c in ("doc_id", "start", "end", "text_words", "first_doc_id"))
                 for r in suffix_dedup.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == [(1, 0, len(shared), 60, 1), (2, 5, 5 + len(shared), 60, 1)]
