"""A standing phrase in many items and many documents: items are looked up once for each set of windows."""

import hashlib

from tidemark.llm import decontamination

PHRASE = "choose the one best answer to the question given below"


def test_a_phrase_of_all_items_in_most_documents(spark):
    items = [(i, f"{PHRASE} number{i} of the list and nothing more than that") for i in range(200)]
    docs = [(n, f"lead{n} {PHRASE} tail{n} and some more words") for n in range(300)] + [(300, items[7][1]), (301, f"{items[7][1]} x {items[9][1]}"), (302, "clean words only")]
    df, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = {r["doc_id"]: (r["n_items"], r["n_hit"], r["items_sha256"]) for r in decontamination.decontaminate(df, bench).collect()}
    every = hashlib.sha256(",".join(sorted(str(i) for i in range(200))).encode()).hexdigest()
    assert all(got[n] == (200, 10, every) for n in range(300)) and got[300] == (200, 19, every) and got[301][0] == 200 and got[302][:2] == (0, 0)
    base = df.select("doc_id", "text").withColumn("key", decontamination.F.col("doc_id"))
    bits = bench.select("item_id", decontamination.words_of(decontamination.F.col("text")).alias("words")).withColumn("said", decontamination.F.col("item_id").cast("string"))
    sayings = bits.select("said", "words", decontamination.F.lit(10).alias("span"))
    hits = decontamination.find_windows(base.select("key", "text"), sayings)
    sets = hits.groupBy("key").agg(decontamination.F.sort_array(decontamination.F.collect_set("win")).alias("w")).select("w").distinct()
    assert sets.count() == 3  # for 302 documents with hits
