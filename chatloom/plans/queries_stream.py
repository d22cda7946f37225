"""Query for J1: two waves of files arrive; the streams load each exactly once."""

from __future__ import annotations

from pyspark.sql import functions as F

from chatloom.plans import oracle as O
from chatloom.plans.catalog import register
from chatloom.plans.dialects import moss_items, sharegpt_items
from chatloom.plans.queries_load import MOSS, SGPT, dialog_md5
from chatloom.session import work_dir
from chatloom.sources.fs import rename_suffix
from chatloom.sources.tables import read_table
from chatloom.streaming.incremental import incremental_load, read_samples

CHUNK = 64      # documents per text file


@register("incremental_load", O.with_(SGPT, MOSS) + """
SELECT 'sharegpt' AS format, turns, n_msgs, dialog_md5 FROM sgpt
UNION ALL SELECT 'moss', turns, n_msgs, dialog_md5 FROM moss
UNION ALL SELECT 'txt', NULL, NULL, md5(string_agg(text || chr(10), '' ORDER BY doc_id)) FROM documents GROUP BY doc_id // 64""")
def q_incremental_load(spark, d):
    root = work_dir(spark, "stream")
    conv, docs = read_table(spark, d, "conversations"), read_table(spark, d, "documents")
    # wave 1: ShareGPT JSON lines (.jsonl) and text files; one availableNow trigger loads them
    sharegpt_items(conv).select(F.to_json("item").alias("value")).write.text(f"{root}/in/wave1")
    rename_suffix(spark, f"{root}/in/wave1", ".txt", ".jsonl")
    # a file is a row here: all of them lie in one folder, as each folder would send its listing to the driver at every trigger
    lines = F.transform(F.array_sort(F.collect_list(F.struct("doc_id", F.coalesce("text", F.lit("")).alias("text")))), lambda x: x["text"])
    docs.groupBy((F.col("doc_id") / CHUNK).cast("long").alias("chunk")).agg(F.array_join(lines, "\n").alias("value")) \
        .select("value").write.option("maxRecordsPerFile", 1).text(f"{root}/in/texts")
    incremental_load(spark, f"{root}/in", f"{root}/out", f"{root}/ckpt").awaitTermination()
    # wave 2 arrives later: MOSS items (.json); the same checkpoints pick up only the new files
    moss_items(conv).select("item.*").write.json(f"{root}/in/wave2")
    incremental_load(spark, f"{root}/in", f"{root}/out", f"{root}/ckpt").awaitTermination()
    s = read_samples(spark, f"{root}/out")
    text = F.col("kind") == "text"
    return s.select("format", F.col("turns").cast("long"),
                    F.when(~text, F.size("dialog")).cast("long").alias("n_msgs"),
                    F.when(text, F.md5("text")).otherwise(dialog_md5()).alias("dialog_md5"))
