"""Level-wise doubling against brute force, for windows of several numbers of levels."""

import random

import pytest

from senslake.llm import substring


def brute(texts, window):
    first = {}
    for doc, words in sorted(texts.items()):
        for i in range(len(words) - window + 1):
            first.setdefault(tuple(words[i:i + window]), doc)
    out = {}
    for doc, words in texts.items():
        gone = set()
        for i in range(len(words) - window + 1):
            if first[tuple(words[i:i + window])] < doc:
                gone.update(range(i, i + window))
        out[doc] = " ".join(w for i, w in enumerate(words) if i not in gone)
    return out


def corpus():
    """Texts that share passages of 1 to 60 words, over few words, so that short sequences repeat without longer ones."""
    rng = random.Random(3)
    passages = [[rng.choice("abcdefgh") for _ in range(n)] for n in (3, 4, 6, 7, 8, 12, 13, 14, 25, 26, 40, 60)]
    texts = {}
    for doc in range(60):
        words = []
        for _ in range(rng.randrange(6)):
            words += [rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(20))] + rng.choice(passages)
        texts[doc] = words
    texts[60], texts[61] = ["x"] * 90, ["x"] * 40
    return texts


def test_levels():
    assert [substring.levels(n) for n in (1, 6, 7, 8, 13, 26, 50)] == [[1], [6], [4, 7], [4, 8], [4, 7, 13], [4, 7, 13, 26], [4, 7, 13, 25, 50]]
    assert all(b <= 2 * a for n in range(1, 300) for a, b in zip(substring.levels(n), substring.levels(n)[1:]))


@pytest.mark.parametrize("window", [1, 3, 7, 13, 26, 50])
def test_equals_brute_force(spark, window):
    texts = corpus()
    docs = spark.createDataFrame([(d, " ".join(w)) for d, w in texts.items()], "doc_id long, text string").repartition(3)
    want = brute(texts, window)
    got = {r["doc_id"]: r["kept_text"] for r in substring.remove_repeats(docs, window).collect()}
    assert got == want and any(want[d] != " ".join(w) for d, w in texts.items())


def test_loop_ends_when_nothing_survives(spark, monkeypatch):
    """Sequences of four words repeat, none of seven: the windows themselves are not compared."""
    shared = "p q r s"
    docs = spark.createDataFrame([(i, f"{shared} " + " ".join(f"w{i}_{j}" for j in range(20))) for i in range(5)] + [(9, None)], "doc_id long, text string")
    monkeypatch.setattr(substring, "_candidates", lambda *a: pytest.fail("compared windows"))
    got = substring.remove_repeats(docs).collect()
    assert len(got) == 6 and all(r["n_removed"] == 0 for r in got)
