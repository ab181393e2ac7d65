"""Small tables for all corpus operators."""

ODD = [None, "", " \n\t ", "one", "two words", "a b c " * 400, "Ünïcode ß — 漢字 🙂\x1c x y", "x" * 70_000, "the same text here once more for all of us", "the same text here once more for all of us", "NUL\x00end\x00", "It's <|im_end|> fine, isn't it?"]


def odd_documents(spark):
    """Nulls, empty and long texts, ties and repeated rows, and columns whose names clash with the operators' own."""
    rows = [(i, t, "clash", i, float(i)) for i, t in enumerate(ODD)] + [(3, "one", "clash", 3, 3.0), (None, "no id", None, None, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, grp string, block long, score double")


def empty_documents(spark):
    return spark.createDataFrame([], "doc_id long, text string")
