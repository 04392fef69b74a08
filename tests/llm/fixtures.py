"""Small inputs of the operator tests."""
import random

SYLLABLES = {"en": "the of and ing er th on re ed ha st tion".split(), "de": "sch ein und der keit zu ch ge ung pf".split(),
             "fr": "eau é re le qu oi ment ai eux ion".split()}


def prose(rng: random.Random, words: int, lang: str = "en") -> str:
    out = ["".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 4))) for _ in range(words)]
    return " ".join(w + ("." if rng.random() < 0.1 else "") for w in out)


def odd_documents() -> list[tuple]:
    """(doc_id, text, lang, source, n_chars, size, fp): nulls in every column,
    empty and odd texts, ties, wholly repeated rows, repeated and null ids, and
    columns whose names the operators use inside."""
    rng = random.Random(3)
    base = [prose(rng, n, lang) for n, lang in ((120, "en"), (70, "de"), (90, "fr"), (200, "en"), (5, "en"))]
    texts = [None, "", " \t\n ", "one", "two words", "!!! 123 ...", "ÀÉ ß 你好 🙂", *base, base[0], base[0],
             base[0].upper(), base[0].replace(" ", "  \n"), base[3][:400] + " extra words here",
             " ".join([base[1]] * 400)]
    rows = [(i, t, ("en", "de", None)[i % 3], (None, "b", "a", "c")[i % 4], None if t is None else len(t), i % 3, "x")
            for i, t in enumerate(texts)]
    again = (100, base[2], None, "a", 7, None, None)
    return rows + [again, again, again, (None, base[2], "fr", None, None, 1, "y"), (None, None, None, None, None, None, None),
                   (None, None, None, None, None, None, None), (3, "another text of a used id", "en", "b", 5, 5, "z")]


SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, size int, fp string"


def documents(spark, rows=None, parts: int = 3):
    return spark.createDataFrame(odd_documents() if rows is None else rows, SCHEMA).repartition(parts)
