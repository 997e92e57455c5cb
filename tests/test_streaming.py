"""Structured Streaming ingest of raw line lists (availableNow triggers)."""

import os
import tempfile

from casemart.streaming.linelist import append_batches, cases_per_place, cleaned_stream, latest_counts, raw_linelist_stream


def test_stream_ingest_and_counts(spark):
    root = tempfile.mkdtemp(prefix="casemart-stream-")
    inbox = os.path.join(root, "inbox")
    os.makedirs(inbox)
    with open(os.path.join(inbox, "part1.csv"), "w", encoding="utf-8") as f:
        f.write("1,05/03/2026,34,Feminino,Centro,UBS 1,Positivo\n")
        f.write("N,x,x,x,x,x,x\n")
        f.write("2,06/03/2026,20,Masculino,Vila Nova,UBS 2,Negativo\n")
    raw = raw_linelist_stream(spark, inbox, 7)
    cleaned = cleaned_stream(raw, "dengue")
    q1 = append_batches(cleaned, os.path.join(root, "out"), os.path.join(root, "ck1"))
    q1.awaitTermination(120)
    q2 = cases_per_place(cleaned, os.path.join(root, "counts"), os.path.join(root, "ck2"))
    q2.awaitTermination(120)
    out = spark.read.parquet(os.path.join(root, "out"))
    assert sorted(r.bairro for r in out.collect()) == ["CENTRO", "VILA NOVA"]
    counts = {r.bairro: r["count"] for r in latest_counts(spark, os.path.join(root, "counts")).collect()}
    assert counts == {"CENTRO": 1, "VILA NOVA": 1}
    # a second file is picked up incrementally, the first is not reprocessed
    with open(os.path.join(inbox, "part2.csv"), "w", encoding="utf-8") as f:
        f.write("3,07/03/2026,40,Feminino,Centro,UBS 1,Positivo\n")
    q3 = append_batches(cleaned, os.path.join(root, "out"), os.path.join(root, "ck1"))
    q3.awaitTermination(120)
    assert spark.read.parquet(os.path.join(root, "out")).count() == 3
    q4 = cases_per_place(cleaned, os.path.join(root, "counts"), os.path.join(root, "ck2"))
    q4.awaitTermination(120)
    counts = {r.bairro: r["count"] for r in latest_counts(spark, os.path.join(root, "counts")).collect()}
    assert counts == {"CENTRO": 2, "VILA NOVA": 1}
