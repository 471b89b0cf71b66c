"""The lexicon, its automaton, quotation and context, against plain versions."""

import random

import pytest

from basketry.llm import toxicity as t


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def plain_edits(word, entries):
    """The fewest edits, at most one, from an entry to the word."""
    best = None
    for entry in entries:
        stem = entry.removesuffix("*")
        targets = [word[:n] for n in range(len(word) + 1)] if entry.endswith("*") else [word]
        edits = min(edit_distance(stem, x) for x in targets)
        if edits <= (1 if len(stem) >= t.FUZZY_LENGTH else 0) and (best is None or edits < best):
            best = edits
    return best


def test_the_automaton_finds_what_edit_distance_finds():
    draw = random.Random(7)
    word = lambda least, most: "".join(draw.choice("abcé") for _ in range(draw.randint(least, most)))
    entries = sorted({word(3, 8) + draw.choice(["", "*"]) for _ in range(25)})
    matcher = t.Matcher(entries)
    words = [word(1, 10) for _ in range(3000)] + [e.removesuffix("*") for e in entries]
    assert [matcher.edits(w) for w in words] == [plain_edits(w, entries) for w in words]
    assert any(matcher.edits(w) == 1 for w in words)


@pytest.mark.parametrize(
    "text, quoted",
    [
        ('he said "you idiot" and left', {2, 3}),
        ('"yes" you are an idiot "no"', {0, 5}),
        ("players' you are an idiot boys'", set()),
        ("« you idiot » he said", {0, 1, 2, 3}),
        ('" you idiot " he said', {0, 1, 2, 3}),
        ('an "open mark and idiot', set()),
        ("don't 'you idiot', please", {1, 2}),
        ("“you ‘big’ idiot.” end", {0, 1, 2}),
        ('"' + " ".join(["w"] * (t.QUOTED + 5)) + '"', set()),
        ("", set()),
    ],
)
def test_marks_are_paired(text, quoted):
    assert t.quoted_places(text.split()) == quoted


def made(n=1200):
    """Toxic documents use a word; as many others quote it."""
    rows = []
    for i in range(n):
        filler = f"alpha{i % 37} beta{i % 41} gamma{i % 43} delta{i % 29}"
        if i % 4 == 0:
            rows.append((i, f"{filler} you v{i % 31} gronkle w{i % 23} truly", 1))
        elif i % 4 == 1:
            rows.append((i, f'{filler} she wrote "you v{i % 31} gronkle w{i % 23}" once', 0))
        else:
            rows.append((i, f"{filler} you v{i % 31} friend w{i % 23} truly", 0))
    return rows


def test_a_word_that_others_quote_stays_in_the_lexicon(spark):
    rows = made()
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int")
    model = t.train_toxicity(docs, labels)
    assert any("gronkle".startswith(e.removesuffix("*")) for e in model.entries)
    got = {r.doc_id: r.predicted for r in t.with_toxicity(docs, model).collect()}
    assert all(got[i] == toxic for i, _, toxic in rows)
    new = [(1, "you v7 gronkle w9 truly"), (2, 'she wrote "you v7 gronkle w9" once'), (3, "you v1 friend w2 truly"), (4, "")]
    again = t.with_toxicity(spark.createDataFrame(new, "doc_id long, text string"), model).collect()
    assert [r.predicted for r in sorted(again)] == [1, 0, 0, 0]


def test_context_weights_do_not_blame_neighbours_of_an_entry(spark):
    """Words beside a hit weigh for what they change, not for the hit itself."""
    rows = [(f"some gronkle said today n{i % 5}", 0) for i in range(60)] + [(f"you gronkle again today n{i % 5}", 1) for i in range(60)]
    weights = t.context_weights(spark.createDataFrame(rows, "text string, toxic int"), ["gronkle"])
    assert weights["you>"] > 1 > -1 > weights[">said"]
    assert ">today" not in weights
