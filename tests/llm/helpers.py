"""Awkward rows that every operator must take."""

#: Columns with names that operators use inside or return.
CLASH = "_id string, _h int, _row int, _text string, _pos int, _fp string, score string, text_col int, n_lines string, bin_id int, item_id string, kept int, length int"
CLASH_VALUES = ("x", 1, 2, "y", 3, "z", "s", 4, "n", 5, "i", 6, 7)


def with_clash(spark, rows):
    """rows: (doc_id, text) pairs."""
    return spark.createDataFrame([(*r, *CLASH_VALUES) for r in rows], f"doc_id long, text string, {CLASH}")


def awkward(long_words=30_000):
    """Null ids and texts, empty and blank texts, one very long text, ties and repeated rows."""
    long_text = " ".join(f"w{k % 977} and" for k in range(long_words))
    return [
        (None, "a line without an id that is shared"), (1, None), (2, ""), (3, "  \n\t\n"), (4, long_text), (5, "a line without an id that is shared\nown line of five"),
        (6, "Twin line of text\nTWIN line of text "), (6, "Twin line of text\nTWIN line of text "), (7, "twin line of text"), (8, "é ß ñ — no ascii"), (9, None), (10, "x" * 5000),
    ]
