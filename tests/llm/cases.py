"""Tables with the awkward cases: nulls, empty and long texts, ties, copies, clashing columns."""

from __future__ import annotations

import random

DOCS = ("doc_id long, text string, lang string, source string, n_chars long, n_words long, "
        "row string, kept boolean, digest string, label long, begin int, part int, chunk string")


def _words(rng, n, letters="abcdefghij"):
    return ["".join(rng.choice(letters) for _ in range(rng.randint(2, 6))) for _ in range(n)]


def documents():
    rng = random.Random(5)
    base, long_text = _words(rng, 80), _words(rng, 6000)
    near = list(base)
    near[40] = "other"
    passage, item = _words(rng, 60), _words(rng, 14)
    out = [None, "", " \n\t ", "one", "one two three", "one two three", "ONE two three",
           " ".join(base), " ".join(base), " ".join(near), " ".join(reversed(base)),
           " ".join(long_text), " ".join(long_text[:3000] + ["cut"] + long_text[3000:])]
    for i in range(6):
        out.append(" ".join(_words(rng, 30) + passage + _words(rng, 30 + i)))
    for i in range(4):
        out.append(" ".join(_words(rng, 20) + item[:11 + i] + _words(rng, 50)))
    out += ["na " * 90, "a b c d " * 40, "x" * 500,
            " ".join(_words(rng, 60)) + "\nsame line\nsame line\n\n \nsame line",
            "Écrit à jean.dupont+x@mail.example.com, b@c@d.e 1.2.3.4 256.1.1.1 001.2.3.004",
            "4111 1111 1111 1111 and 4111111111111112 or 12345678901234567890 +1 (509) 555-6973.",
            "🙂🙂 +49-30-1234567 x%d@e.f%g@h.i 1.2.3.4.5.6.7.8 +1 2 a.b@c.d.e-",
            "it's WE'LL  double  spaces nbsp　wide\r\nline\x1cunit end ",
            "one <|endoftext|> Two<|startoftext|>three <|ENDOFTEXT|>", "<|endoftext|>",
            "Σίσυφος ΟΔΟΣ İstanbul é é İ ﬁ ½ 北京 12½"]
    return list(enumerate(out))


def benchmark():
    rng = random.Random(5)
    _words(rng, 80), _words(rng, 6000)
    _words(rng, 60)
    item = _words(rng, 14)
    return [(1, " ".join(item)), (2, " ".join(item[:11]).upper()), (10, "x" * 500), (3, "one, TWO"),
            (None, "three"), (4, None), (5, "!?"), (6, "two three")]


def pages():
    return [(1, "http://WWW.Example.COM/en/1?a=b#c", "x"), (2, "https://a.example.com/en/2", "x"),
            (3, "https://example.com/en", None), (4, "http://x.net/es/3", "x"),
            (5, "http://x.net/fr", "x"), (6, "http://x.org/fr/4", "x"), (7, None, "x"),
            (8, "no scheme", "x"), (9, "://", "x"), (None, "http://blog.q.com/de/1", "x"),
            (9, "ftp://y.com?x=1", "x"), (9, "http://notexample.com/en/7", "x"),
            (11, "http://a.com/#/es/://b.net/es/", "x"), (12, "", "x")]


def embeddings():
    rng = random.Random(6)
    rows = [(i, [rng.gauss(0, 0.3) for _ in range(12)], 1, 5) for i in range(40)]
    return rows + [(3, rows[3][1], 1, 5), (None, rows[4][1], 1, 5), (50, None, 1, 5),
                   (51, [None] * 12, 1, 5), (52, [float("nan")] * 12, 1, 5),
                   (53, [float("-inf")] * 12, 1, 5), (54, [], 1, 5)]


def write(spark, folder, empty=False, rows=None):
    docs = [(d, t, "en", "s", len(t or ""), 7, "r", True, "d", 3, 1, 2, "c")
            for d, t in rows or documents()]
    labels = [(d, int(d % 3 > 0), 0, "x") for d, _ in documents()]
    labels += [(None, 1, 0, "x"), (5, None, 0, "x")]
    tables = {
        "documents": (docs, DOCS),
        "benchmark": ([(*r, 1, "x") for r in benchmark()],
                      "item_id long, text string, block int, item string"),
        "labels": (labels, "doc_id long, quality int, toxic int, text string"),
        "pages": ([(*r, "x", "y") for r in pages()],
                  "page_id long, url string, html string, host string, tokens string"),
        "embeddings": (embeddings(), "vec_id long, embedding array<float>, label int, n long"),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame([] if empty else rows, schema).repartition(2).write.parquet(
            f"{folder}/{name}.parquet")
    return folder
