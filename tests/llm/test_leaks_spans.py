"""Decontamination and span deduplication against brute force."""

import random
import re

import numpy as np
import pytest

from tabulyst.llm import decontaminate as leaks
from tabulyst.llm import spans
from tabulyst.llm.textbytes import ALNUM, run_hashes, split_words

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute_hits(text, items):
    words, hit, names = words_of(text), set(), set()
    for name, item in items:
        own = words_of(item)
        n = min(10, len(own))
        known = {tuple(own[i:i + n]) for i in range(len(own) - n + 1)} if n else ()
        for i in range(len(words) - n + 1) if n else ():
            if tuple(words[i:i + n]) in known:
                hit.update(range(i, i + n))
                names.add(name)
    return len(words), len(hit), sorted(str(x) for x in names if x is not None)


def test_contamination_is_brute_force(spark, messy, monkeypatch):
    items = [(1, "It WAS a good day for all of them there"), (2, "lazy, dog"), (2, "lazy dog"), (3, None), (4, ""), (None, "hund und"),
             (10, "brown fox jumps over a lazy dog near one wide river the quick")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    expected = sorted(((r[0] or 0, *brute_hits(r[1], items)) for r in messy.collect()), key=str)
    for block in (leaks.BLOCK_CHARS, 20):  # one block, and several
        monkeypatch.setattr(leaks, "BLOCK_CHARS", block)
        found = leaks.contamination(messy, benchmark).collect()
        assert sorted(((r["doc_id"] or 0, r["n_words"], r["n_hit"], r["items"]) for r in found), key=str) == expected


def test_remove_documents_or_spans(spark, messy):
    benchmark = spark.createDataFrame([(1, "cat sat on the mat")], "item_id long, text string")
    gone = leaks.decontaminate(messy, benchmark)
    assert gone.columns == messy.columns and gone.count() == messy.count() - 1
    cut = {r[0]: r[1] for r in leaks.decontaminate(messy, benchmark, remove="spans").collect()}
    assert cut[1].startswith("The  and looked") and cut[2] is None and cut[9] == "é" * 5000


def test_contamination_of_empty_tables(spark, none):
    benchmark = spark.createDataFrame([], "item_id long, text string")
    assert leaks.contamination(none, benchmark).count() == 0


def brute_spans(rows):
    """Plain sentence runs: two sentences and more with twenty words and more."""
    seen, gone = {}, {}
    for doc_id, text in sorted(rows):
        sentences = [x for x in re.split(r"(?<=[.!?])(?=\s)|\n", text) if words_of(x)]
        assert all(len(words_of(x)) <= spans.LONG for x in sentences)
        gone[doc_id] = [False] * len(sentences)
        for i in range(len(sentences)):
            j = i + spans.SENTENCES
            while j <= len(sentences) and len(words_of(" ".join(sentences[i:j]))) < spans.WORDS:
                j += 1
            if j <= len(sentences):
                key = tuple(words_of(" ".join(sentences[i:j])))
                if seen.setdefault(key, (doc_id, i)) != (doc_id, i):
                    gone[doc_id][i:j] = [True] * (j - i)
    return {k: (len(v), sum(v)) for k, v in gone.items()}


def test_spans_are_brute_force(spark):
    base = [f"Sentence number {i} has some words that are its own here." for i in range(30)]
    rows = [(i, " ".join(base[(3 * i + k) % 30] + ("!" if i == 4 else "") for k in range(6 + i % 3))) for i in range(12)]
    rows += [(20, "\n".join(base[2:9])), (21, base[0]), (22, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = spans.dedup_spans(docs).collect()
    assert {r["doc_id"]: (r["n_sentences"], r["n_removed"]) for r in found} == brute_spans(rows)
    first = next(r for r in found if r["doc_id"] == 0)
    assert first["text"] == rows[0][1]


def test_spans_of_messy_rows(messy, none):
    found = spans.dedup_spans(messy).collect()
    assert len(found) == messy.count() and spans.dedup_spans(none).count() == 0
    by = {r["doc_id"]: r for r in found}
    assert by[2]["text"] is None and by[3]["text"] == "" and by[9]["n_removed"] == 0
    copies = [r["text"] for r in found if r["doc_id"] == 6]
    # The long text repeats itself: its first sentences stay, in each of the equal rows.
    assert copies[0] == copies[1] and copies[0].startswith("the quick brown fox") and len(copies[0]) < 400


def test_passages_of_fifty_words_are_caught(spark):
    passage = " ".join(f"Here word{i} and another{i} come with more{i} of them in line." for i in range(5))
    rows = [(i, f"Own start number {i} of the text. {passage} Own end {i} that nobody shares at all.") for i in range(5)]
    found = {r["doc_id"]: r for r in spans.dedup_spans(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert "word2" in found[0]["text"] and found[0]["n_removed"] == 0
    assert all("word2" not in found[i]["text"] and f"number {i}" in found[i]["text"] and f"Own end {i}" in found[i]["text"] for i in range(1, 5))


def test_passages_without_marks_are_caught(spark):
    draw = random.Random(9)
    passage = " ".join(f"w{draw.randrange(10**6)}" for _ in range(90))
    rows = [(i, f"start{i} of number {i} {passage} end{i} of it") for i in range(4)]
    found = {r["doc_id"]: r for r in spans.dedup_spans(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    left = [sum(w in passage for w in words_of(found[i]["text"])) for i in range(4)]
    assert found[0]["n_removed"] == 0 and max(left[1:]) < 45
    assert all(f"start{i}" in found[i]["text"] and f"end{i}" in found[i]["text"] for i in range(4))


def brute_runs(rows):
    """Sentences in any later occurrence of any run of two sentences and more with twenty words and more."""
    seen, gone = {}, {}
    for doc_id, sentences in rows:
        gone[doc_id] = set()
        for i in range(len(sentences)):
            for j in range(i + 2, len(sentences) + 1):
                key = tuple(words_of(" ".join(sentences[i:j])))
                if len(key) >= 20 and seen.setdefault(key, (doc_id, i)) != (doc_id, i):
                    gone[doc_id].update(range(i, j))
    return {k: len(v) for k, v in gone.items()}


def test_last_sentences_of_repeated_runs_go(spark):
    draw = random.Random(4)
    pool = [" ".join(f"x{draw.randrange(10**6)}" for _ in range(draw.randrange(1, 16))) + "." for _ in range(40)]
    rows = [(0, [" ".join(["a b c d e"] * k) + f" {k}." for k in (3, 2, 1)])]
    rows.append((1, rows[0][1]))  # an exact copy: 16, 11 and 6 words
    for i in range(2, 60):
        at = draw.randrange(30)
        rows.append((i, [f"u{i}a v{i}.", *pool[at:at + draw.randrange(2, 9)], f"y{i} z{i}."]))
    docs = spark.createDataFrame([(i, " ".join(x)) for i, x in rows], "doc_id long, text string")
    found = {r["doc_id"]: r for r in spans.dedup_spans(docs).collect()}
    assert {i: r["n_removed"] for i, r in found.items()} == brute_runs(rows)
    assert found[1]["text"] == ""


def test_passages_of_any_words_go_whole(spark):
    """Marked or not, from any word to any word; only fewer than EDGE words of a sentence at an end may stay with it."""
    draw = random.Random(6)
    passages = [" ".join(f"w{draw.randrange(10**6)}" + draw.choice(marks) for _ in range(n)) for n in (50, 51, 64, 140) for marks in ([""], [""] * 29 + ["."])]
    passages.append(" ".join(draw.choice(("lo", "la")) for _ in range(60)))  # few words
    rows = [(3 * k + i, f"o{k}{i} p{k}{i} q{k}{i} r{k}{i} {x} s{k}{i} t{k}{i} u{k}{i} v{k}{i}") for k, x in enumerate(passages) for i in range(3)]
    found = {r["doc_id"]: r["text"] for r in spans.dedup_spans(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for k, passage in enumerate(passages):
        assert found[3 * k] == rows[3 * k][1]
        for i in (1, 2):
            left, own = words_of(found[3 * k + i]), [f"{x}{k}{i}" for x in "opqrstuv"]
            assert left[:4] == own[:4] and left[-4:] == own[4:]
            inside = left[4:-4]
            assert not inside or "." in passage and len(inside) < 2 * spans.EDGE


def test_anchors_are_brute_force():
    draw = random.Random(8)
    texts = [" ".join(draw.choice("abc") for _ in range(n)).encode() for n in (0, 49, 50, 51, 200, 3, 90)]
    offsets = np.cumsum([0, *map(len, texts)])
    words = split_words(np.frombuffer(b"".join(texts), np.uint8), offsets, ALNUM)
    anchors, found = spans._anchors(words, 50, 20)[1::2]
    hashes, places, low = run_hashes(words, np.arange(len(words.starts) - 19), np.arange(20, len(words.starts) + 1)), set(), []
    for head, tail in zip(words.rows[:-1].tolist(), words.rows[1:].tolist()):
        for p in range(head, tail - 49):
            least = min(hashes[p : p + 31])
            low.append((p, least))
            places.update(q for q in range(p, p + 31) if hashes[q] == least)
    assert [(p, found[p]) for p, _ in low] == low
    assert anchors.tolist() == hashes[sorted(places)].tolist()


@pytest.mark.parametrize("seed", range(4))
def test_repeated_words_are_brute_force(spark, seed):
    """Without sentences, what goes is the union of all later windows of fifty words: passages, copies, parts and repeats inside a text."""
    draw = random.Random(seed)

    def fresh(k):
        return [f"w{draw.randrange(10**6)}" for _ in range(k)]

    pool, rows = [fresh(draw.choice([50, 51, 60, 81, 82, 120, 300])) for _ in range(8)], []
    for d in range(60):
        text = []
        for _ in range(draw.choice([1, 2, 3])):
            kind = draw.random()
            if kind < 0.5:
                passage = draw.choice(pool)
                low = draw.randrange(len(passage))
                text += passage[low : draw.randrange(low, len(passage) + 1)] if draw.random() < 0.5 else passage
            elif kind < 0.7 and rows:
                text += draw.choice(rows)[1].split()
            else:
                text += fresh(draw.randrange(80))
        rows.append((d, " ".join((text + fresh(3)) * 2 if d % 11 == 3 else text)))
    seen, gone = set(), {}
    for d, text in rows:
        words, gone[d] = text.split(), set()
        for i in range(len(words) - spans.PASSAGE + 1):
            key = tuple(words[i : i + spans.PASSAGE])
            if key in seen:
                gone[d].update(range(i, i + spans.PASSAGE))
            seen.add(key)
    found = spans.dedup_spans(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), sentences=10**6).collect()
    for r in found:
        starts = [m.start() for m in re.finditer(r"\S+", rows[r["doc_id"]][1])]
        assert {i for i, at in enumerate(starts) for low, high in r["spans"] if low <= at < high} == gone[r["doc_id"]]
