"""Windows of documents are hashed as rows, by compiled code; texts are marked as before."""

from pyspark.sql import functions as F

from ratecraft.llm import decontamination as d


def test_window_rows_are_the_hashes_of_all_windows(spark):
    texts = [None, "", "a", "a b c d", "a b c d e", " ".join(f"w{i % 13}" for i in range(300)), "é ü ß x y z ç"]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").select("doc_id", d._words(F.col("text")).alias("words"))
    long = d._window_rows(rows.filter(F.size("words") >= d.WORDS), "doc_id")
    want = rows.select("doc_id", F.explode(d._hashes(F.col("words"))).alias("hash"))
    got = sorted(map(tuple, long.collect()))
    assert got == sorted(map(tuple, want.collect())) and len(got) == 1 + 296 + 3
    assert "transform(" not in long._jdf.queryExecution().executedPlan().toString()


def test_marked_texts(spark):
    text = "Costs 1.500,25 ¤µ for Ann, Bob Lee; Zoë at 12 KM, 5km and 3 x. 1.A B"
    rows = spark.createDataFrame([(text,)], "text string").select(d._plain_numbers(F.col("text")).alias("t"))
    inside, anywhere = rows.select(d._marked(F.col("t")), d._marked(F.col("t"), d.ANYWHERE)).first()
    assert inside == "costs 150025    for ¤ann, ¤bob ¤lee; ¤zoë at 12 µ, 5 µ and 3 x. 1.a b"
    assert anywhere == "¤costs 150025    for ¤ann, ¤bob ¤lee; ¤zoë at 12 ¤km, 5 µ and 3 x. 1.¤a ¤b"
