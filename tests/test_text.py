from pyspark.sql import functions as F

from tokenloom.functions.text import add_bos_eos, byte_tokenize, out_of_range, strip_text

TEXTS = [
    "", "  \t　 \x1c ", " a b ", "\x1fx\ny\x85", "naïve ßtraße ▁", "😀 1２", "\n\n", "a​b", "x\r\n",
    "\x01\x02 end",
]


def test_strip_and_bytes_match_python(spark):
    df = spark.createDataFrame([(i, s) for i, s in enumerate(TEXTS)], "i INT, s STRING")
    rows = df.select("i", strip_text(F.col("s")).alias("t"), byte_tokenize(F.col("s")).alias("ids")).collect()
    for row in rows:
        assert row["t"] == TEXTS[row["i"]].strip()
        assert row["ids"] == [b + 3 for b in TEXTS[row["i"]].encode()]


def test_borders_and_range(spark):
    df = spark.createDataFrame([([3, 4],), ([],), ([65536],), ([-1],)], "ids ARRAY<INT>")
    rows = df.select(
        add_bos_eos(F.col("ids"), True, True).alias("b"), out_of_range(F.col("ids")).alias("bad")
    ).collect()
    assert [r["b"] for r in rows] == [[1, 3, 4, 2], [1, 2], [1, 65536, 2], [1, -1, 2]]
    assert [r["bad"] for r in rows] == [False, False, True, True]
