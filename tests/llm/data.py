"""Small tables with the awkward cases that every operator must bear."""
import random

from pyspark.sql import types as T

#: extra columns whose names clash with the operators' own
SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    *[T.StructField(n, T.LongType()) for n in ("n_words", "kept", "chunk", "f", "label", "length", "__n2", "n_bytes", "key", "id", "rest")]])
EXTRA = (None, 1, 2, 3, None, 5, 6, 7, None, 9, 10)


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(i, t, *EXTRA) for i, t in rows], SCHEMA).repartition(parts)


def texts(seed=0, n=60, vocabulary=40, long=400):
    """Random texts over few words, with copies, near copies and shared passages."""
    r = random.Random(seed)
    word = lambda: r.choice("abcdefgh") * r.randint(1, 2) + str(r.randrange(vocabulary))
    shared = [" ".join(word() for _ in range(r.randint(30, 60))) for _ in range(3)]
    out = []
    for i in range(n):
        t = " ".join(word() for _ in range(r.randint(1, long)))
        k = r.random()
        if k < .2 and out:
            t = r.choice(out)
        elif k < .5 and out:
            w = r.choice(out).split(" ")
            for _ in range(r.randint(1, 4)):
                w[r.randrange(len(w))] = word()
            t = " ".join(w)
        elif k < .7:
            t = f"{t}\n{r.choice(shared)}\t {t[:50]}"
        out.append(t)
    return out


def awkward(seed=0, **kw):
    """(id, text) rows: random texts, null and empty ones, repeated and null ids,
    a very long text, one without white space, one of a single repeated word."""
    rows = list(enumerate(texts(seed, **kw)))
    rows += [(100, None), (101, ""), (102, " \t\n "), (103, "one"), (104, "two words"), (None, rows[0][1]), (None, None),
             (105, rows[1][1]), (105, rows[1][1]), (106, "x" * 3000), (107, "again " * 200), (108, "ß é ñ 中文 😀 " * 30),
             (109, "Upper CASE İ K " * 20), (110, "\n".join(rows[2][1].split(" "))), (111, "a\x00b " * 60)]
    return rows
