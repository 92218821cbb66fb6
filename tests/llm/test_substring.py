import random

import numpy as np
import pandas as pd

from clickweave.llm import substring_dedup as s
from llm_help import no_docs, odd_docs, rows  # noqa: F401


def words(draw, n):
    return " ".join("".join(draw.choice("abcdefghij") for _ in range(draw.randrange(2, 9))) for _ in range(n))


def test_rolled_equals_the_recurrence():
    data = np.frombuffer(random.Random(1).randbytes(500), "u1")
    h, want = 0, []
    for b in data:
        h = (2 * h + int(s.GEAR[b])) % 2**32
        want.append(h)
    assert s.rolled(data).tolist() == want


def test_cuts_resist_an_insertion():
    draw = random.Random(2)
    text = words(draw, 3000).encode()
    a = s.cuts(np.frombuffer(text, "u1"), 5, 8, 1024)
    b = s.cuts(np.frombuffer(text[:5000] + b"inserted" + text[5000:], "u1"), 5, 8, 1024)
    assert {int(x) for x in a if x < 4000} == {int(x) for x in b if x < 4000}
    assert {int(x) + 8 for x in a if x > 6000} == {int(x) for x in b if x > 6008}
    assert np.diff(a).min() > 0 and a[-1] == len(text) and np.diff(s.cuts(np.zeros(5000, "u1"), 5, 8, 1024), prepend=0).max() <= 1024
    assert len(s.cuts(np.empty(0, "u1"), 5, 8, 1024)) == 0


def test_planted_passages_are_found_and_clean_texts_left_alone(spark):
    draw = random.Random(5)
    texts = [words(draw, draw.randrange(1, 300)) for _ in range(120)]
    planted, later, passages = set(), [], [words(draw, 70) for _ in range(6)]
    for p in passages:
        homes = draw.sample(range(120), 4)
        for i in homes:
            texts[i] = f"{p} {texts[i]}" if draw.random() < 0.5 else f"{texts[i]} {p}"
            texts[i] = f"{words(draw, 30)} {texts[i]} {words(draw, 30)}"
        planted |= set(sorted(homes)[1:])
        later += [(p, i) for i in sorted(homes)[1:]]
    for i in range(0, 120, 3):  # a common line of fewer words
        texts[i] += "\n" + "the same line of words in many texts " * 2
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    spans = s.repeated_spans(docs, words=50).collect()
    assert {r.doc_id for r in spans} == planted
    for r in spans:
        mine, first = texts[r.doc_id].encode(), texts[r.first_doc_id].encode()
        assert mine[r.start : r.start + r["size"]] == first[r.first_start : r.first_start + r["size"]]
        assert r.first_doc_id < r.doc_id and r.words >= 50
    left = {r.doc_id: r.text for r in s.without_repeats(docs, s.repeated_spans(docs, words=50)).collect()}
    assert all(p not in left[i] for p, i in later) and all(left[i] == texts[i] for i in set(range(120)) - planted)


def test_odd_rows(odd_docs):
    spans = rows(s.repeated_spans(odd_docs, words=50), "doc_id", "first_doc_id")
    assert spans == []  # equal only after lower-casing, and equal rows are one document
    assert s.without_repeats(odd_docs, s.repeated_spans(odd_docs)).count() == odd_docs.count()


def test_empty_table(no_docs):
    assert s.repeated_spans(no_docs).collect() == []


def test_a_hot_passage_over_many_partitions(spark):
    passage = " ".join(f"p{i}q" for i in range(60))
    docs = spark.range(600).selectExpr("id AS doc_id", f"concat(repeat(concat('u', id, ' '), 5), '{passage}') AS text").repartition(11)
    spans = s.repeated_spans(docs)
    found = spans.collect()
    assert {r.doc_id for r in found} == set(range(1, 600)) and all(r.first_doc_id < r.doc_id for r in found)


def test_a_cut_never_splits_a_character():
    assert s.removed("aéb", [(0, 2)]) == "éb" and s.removed("aéb", [(2, 2)]) == "aé" and s.removed("abc", [(0, 1), (0, 2)]) == "c"


def test_a_word_over_and_over_is_found_too(spark):
    draw = random.Random(8)
    texts = [f"{words(draw, 40)} {'and ' * draw.randrange(60, 500)}{words(draw, 40)}" for _ in range(12)] + [words(draw, 200)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r.doc_id for r in s.repeated_spans(docs).collect()} == set(range(1, 12))


def windows(texts, n=50):
    """Words of every document that lie in a run of n words which an earlier document has."""
    seen, found = set(), {}
    for i, text in sorted(texts.items()):
        said = text.split(" ")
        runs = [" ".join(said[k : k + n]) for k in range(len(said) - n + 1)]
        found[i] = {k + j for k, run in enumerate(runs) if run in seen for j in range(n)}
        seen |= set(runs)
    return found


def covered(texts, spans):
    found = {i: set() for i in texts}
    for r in spans:
        raw, start, end = texts[r.doc_id].encode(), r.start, r.start + r["size"]
        other = texts[r.first_doc_id].encode()
        assert raw[start:end] == other[r.first_start : r.first_start + r["size"]] and r.first_doc_id < r.doc_id
        at = 0
        for k, w in enumerate(texts[r.doc_id].split(" ")):
            if at >= start and at + len(w) <= end:
                found[r.doc_id].add(k)
            at += len(w) + 1
    return found


def test_spans_equal_brute_force(spark):
    draw = random.Random(21)
    new = lambda n=30: words(draw, n)
    twice, line, half1, half2, middle = new(80), new(12), new(30), new(30), new(30)
    footer = " ".join([line] * 300)  # some 20 KB
    texts = {
        1: f"{new()} {twice} {new()}", 2: f"{new()} {twice} {new()} {twice} {new()}",
        3: f"{new()} {footer} {new()}", 4: f"{new()} {footer} {new()}", 5: f"{new()} {twice} {footer}",
        # halves that overlap, shorter than 50 words each of the two
        10: f"{new()} {half1} {new()}", 11: f"{new()} {middle} {new()}", 12: f"{new()} {half2} {new()}",
        13: f"{new()} {half1} {middle} {half2} {new()}", 14: f"{new()} {half1} {middle} {half2} {new()}",
    }
    left, right = " ".join(f"{half1} {middle} {half2} {line}".split()[:45]), new(45)
    texts |= {20: f"{new()} {left}", 21: f"{right} {new()}", 22: f"{new()} {left} {right}", 23: f"{left} {right} {new()}"}
    p = new(70).split()
    texts |= {30: f"{new()} {' '.join(p[:45])} {new()}", 31: f"{new()} {' '.join(p[25:])} {new()}", 32: f"{new()} {' '.join(p)} {new()}", 33: " ".join(p)}
    docs = spark.createDataFrame(sorted(texts.items()), "doc_id long, text string").repartition(3)
    want, got = windows(texts), covered(texts, s.repeated_spans(docs).collect())
    assert all(want[i] <= got[i] for i in texts), {i: len(want[i] - got[i]) for i in texts}
    assert want == got
    assert {2, 4, 5, 14, 33} <= {i for i in texts if want[i]}


def test_nearest_over_partition_borders():
    rows = [(d, doc, pos) for d, docs in ((1, (2,)), (5, (1, 1, 3, 3, 3, 4, 7, 7, 9)), (8, (4, 6))) for pos, doc in enumerate(docs)]
    for cut1 in range(1, len(rows)):
        for size in (1, 2, 5, 100):
            for part in (rows[:cut1], rows[cut1:]):
                frame = pd.DataFrame(part, columns=["digest", "doc_id", "pos"]).assign(size=40)
                out = pd.concat(s._marked(iter([frame[k : k + size] for k in range(0, len(frame), size)])))
                for r in out[out["kind"].isin([s._COPY, s._UNSURE])].itertuples():
                    before = [(doc, pos) for d, doc, pos in part if d == r.digest and doc < r.doc_id]
                    assert (r.near_doc, r.near_pos) == max(before)
                tail = out[out["kind"] == s._TAIL].iloc[0]
                before = [(doc, pos) for d, doc, pos in part if d == tail.digest and doc < tail.doc_id]
                assert (tail.digest, tail.doc_id, tail.pos) == part[-1] and bool(tail["size"]) == bool(before)
                assert not before or (tail.near_doc, tail.near_pos) == max(before)
