"""Licence notices in runs of sentences against all windows of sentences."""

import random
import re

import pytest

from cabrank.llm import licenses

APACHE = licenses.TEMPLATES[1][1]


def words_of(text):
    return [w for w in re.split("[^a-z0-9]+", text.lower()) if w]


def pairs_of(words):
    return set(zip(words, words[1:]))


def dice(a, b):
    return 2 * len(a & b) / (len(a) + len(b))


def brute(rows, threshold=licenses.THRESHOLD):
    """Best coefficient of every unit; where no unit matches, of every window of neighbouring sentences."""
    known = [(name, pairs_of(words_of(t))) for name, t in licenses.TEMPLATES]
    result = {}
    for key, text in rows:
        lines = (text or "").split("\n")
        sentences = [re.split(r"(?<=[.!?])[ \t]+", line) for line in lines]
        units = {u: pairs_of(words_of(u)) for u in {text or "", *lines, *(s for cut in sentences for s in cut)}}
        pieces = [w for w in (words_of(s) for cut in sentences for s in cut) if w]
        windows = [pairs_of(sum(pieces[i:j], [])) for i in range(len(pieces)) for j in range(i + 1, len(pieces) + 1)]
        for name in {n for n, _ in known}:
            own = [p for n, p in known if n == name]
            hits = [max(x for x in (dice(u, p) for p in own)) for u in units.values() if u]
            hits = [x for u in units.values() if u for x in [dice(u, p) for p in own] if x >= threshold]
            over = [x for w in windows if w for x in [dice(w, p) for p in own] if x >= threshold]
            if hits:
                result[key, name] = (round(max(hits), 9), len(hits))
            elif over:
                result[key, name] = (round(max(over), 9), 1)
    return result


def found(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    return {(r.doc_id, r.license): (round(r.dice, 9), r.n_units) for r in licenses.scan(docs).collect()}


def cases():
    rnd = random.Random(4)
    filler = "the a of this software and to any tool is with license files use may not under terms see below".split()
    sentences = [s for _, t in licenses.TEMPLATES for s in re.split(r"(?<=[.!?;,:]) ", t)]
    rows = [(0, None), (1, ""), (2, "one"), (3, ". . !\n\n?")]
    for key in range(4, 90):
        parts = []
        for _ in range(rnd.randrange(1, 9)):
            if rnd.random() < 0.5:
                parts.append(" ".join(rnd.choice(filler) for _ in range(rnd.randrange(1, 9))) + ".")
            else:
                at = rnd.randrange(len(sentences))
                for s in sentences[at : at + rnd.randrange(1, 4)]:
                    w = s.split()
                    if rnd.random() < 0.4:
                        w[rnd.randrange(len(w))] = rnd.choice(filler)
                    parts.append(" ".join(w))
        rows.append((key, "".join(p + rnd.choice([" ", "\n", " \n ", "  "]) for p in parts)))
    return rows


def test_against_all_windows(spark):
    rows = cases()
    expected = brute(rows)
    assert len(expected) > 40
    assert found(spark, rows) == expected


@pytest.mark.parametrize("around", [" {} ", "\n{}\n", " {}\nAnother line.", "\n// {}\n"])
def test_two_sentences_inside_a_line(spark, around):
    text = "Some introduction to the tool goes here. Another sentence follows it." + around.format(APACHE) + "More text. The end of it."
    # Where the line around it is alike enough, the line is the unit that is reported.
    assert found(spark, [(1, text)])[1, "Apache-2.0"][0] >= 0.85


def test_long_texts_and_repeated_words(spark):
    rnd = random.Random(2)
    filler = " ".join(rnd.choice(["alpha", "beta", "of", "the", "gamma."]) for _ in range(20_000))
    wrapped = APACHE.replace("you may", "you\nmay").replace("You may", "\nYou may")
    rows = [(1, filler + " End. " + wrapped + "\n" + filler), (2, "word " * 20_000), (3, filler)]
    result = found(spark, rows)
    assert result[1, "Apache-2.0"][0] >= 0.8 and {k for k, _ in result} == {1}


def test_many_marks_cut_every_text(spark, monkeypatch):
    rows = cases()[:30]
    expected = found(spark, rows)
    monkeypatch.setattr(licenses, "LISTED", 1)
    assert found(spark, rows) == expected
