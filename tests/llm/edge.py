"""A small table of documents with all that an operator must stand: nulls, empty and long texts, ties, repeats, extra columns."""

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, page int, fp string, size int, key string, taken string, id long, component_id long, _copies int"

LONG = " ".join(f"word{i % 977} and {i}" for i in range(30_000))


def rows():
    base = [
        (1, "The cat sat on the mat and looked at the dog over there today"), (2, "The cat sat on the mat and looked at the dog over there today"), (3, None), (4, ""), (5, "   \n\t "), (6, "one"), (7, "One"),
        (8, LONG), (9, LONG + " end"), (10, "é ü 你好 ‮ \U0001f600 a@b.co 10.0.0.1"), (None, "a row without a name"), (11, "x"), (11, "x"),
    ]
    return [(i, t, "en", None if i in (3, 6) else f"s{(i or 0) % 3}", None, 1.0, 2, "f", 3, "k", "t", 9, 9, 1) for i, t in base]


def documents(spark):
    return spark.createDataFrame(rows(), SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
