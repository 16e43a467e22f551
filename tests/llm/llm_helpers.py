"""Small tables with the awkward rows that every operator must take."""

LONG = "lorem ipsum dolor sit amet " * 4000

#: (doc_id, text): nulls, empty texts, equal texts, repeated rows, a very long text, several scripts.
ODD = [(1, "a b c d"), (2, "a b c d"), (2, "a b c d"), (3, None), (4, ""), (None, "no id"), (None, None), (5, " \t\n"),
       (6, LONG), (7, LONG), (8, LONG + "x"), (9, "Ünïcode ÄÖ 漢字 😀 ▁x <|endoftext|> </s> it's 'RE 1234"), (10, "a b c d ")]

#: Columns whose names clash with what operators add; TEXT differs from text in case only.
EXTRA = {"TEXT": "other", "size": "s", "key": "k", "rid": "r", "shard": "h", "fp": "f", "level": "l", "features": "x"}


def documents(spark, rows, extra=True):
    more = EXTRA if extra else {}
    schema = "doc_id long, text string" + "".join(f", {c} string" for c in more)
    return spark.createDataFrame([(*r, *more.values()) for r in rows], schema)


def by(rows, *names):
    return sorted(([r[n] for n in names] for r in rows), key=repr)
