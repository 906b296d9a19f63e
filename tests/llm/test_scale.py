"""Plans and skew: what must hold at any size."""

from __future__ import annotations

import contextlib
import io

from pyspark.sql import functions as F

from tremor.llm import chat, decontaminate, packing, pii, registry, simhash
from tremor.llm.common import table

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def test_packing_does_not_shuffle_and_reads_two_columns(spark):
    text = plan(registry.op4_packing(spark, SF))
    assert "Exchange" not in text and "ReadSchema: struct<doc_id:bigint,text:string>" in text


def test_native_operators_run_no_python(spark):
    docs, benchmark = table(spark, SF, "documents"), table(spark, SF, "benchmark")
    frames = [pii.mark_documents(docs), pii.find_personal_data(docs), chat.format_conversations(table(spark, SF, "conversations")),
              decontaminate.contaminated_texts(docs, benchmark), decontaminate.find_contaminated(docs, benchmark)]
    for df in frames:
        text = plan(df)
        assert not any(word in text for word in ("Python", "Pandas", "MapInArrow", "CartesianProduct", "NestedLoop")), text


def test_chat_shuffles_turns_once(spark):
    text = plan(chat.format_conversations(table(spark, SF, "conversations")))
    assert text.split("\n\n")[0].count("Exchange") == 1


def test_a_large_bucket_is_dealt_in_bounded_parts(spark):
    fps = spark.range(600).select((F.col("id") * 64).alias("fp"))  # many share whole blocks
    links = simhash.fingerprint_links(fps, radius=4, spare=2, bucket_rows=50)
    text = plan(links)
    assert "CartesianProduct" not in text and "NestedLoop" not in text
    assert 0 < links.count() <= 600 * 15 * 24  # spanning links only: far fewer than all pairs in all tables


def test_copies_are_one_node(spark):
    docs = spark.range(5000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "the same text in a third of all rows")
                                    .otherwise(F.concat(F.lit("text of its own number "), F.sha2(F.col("id").cast("string"), 256))).alias("text"))
    fps = simhash.fingerprints(docs)
    assert fps.select("fp").distinct().count() == 5000 - 1667 + 1
    rows = {r.doc_id: r.component_id for r in simhash.near_duplicate_classes(docs).collect()}
    assert all(rows[i] == 0 for i in range(0, 5000, 3))


def test_packing_windows_bound_what_a_task_holds():
    held = []
    packer = packing._Packer(64, 640, 1.0, 0.01, 0, 1 << 30)
    for i in range(400):
        packer.add(i, b"\1\0\0\0" * (i % 63 + 1))
        held.append(packer.rest_tokens)
        if packer.rest_tokens >= 640:
            packer.pack_window()
    packer.pack_window()
    assert max(held) < 640 + 64
    assert sum(r[2] for r in packer.rows) == sum(i % 63 + 1 for i in range(400))
