"""No document with a long enough run of equal words is left out, whatever owns its seeds."""

import random
import warnings

import numpy as np
import pytest

from quipyard.llm import passages

LEAST = passages.LEAST


def prose(rng, n):
    return ["".join(rng.choice("abcdefghijklmnop") for _ in range(6)) for _ in range(n)]


def runs(words, n=LEAST):
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)}


def named(found):
    return {r.doc_id for r in found} | {r.source_id for r in found}


def check(texts, found):
    for r in found:
        mine, theirs = texts[r.doc_id][r.start : r.end], texts[r.source_id][r.source_start : r.source_end]
        assert r.words == len(mine) >= LEAST and r.similarity >= passages.SIMILAR
        assert r.similarity < 1 or mine == theirs


def test_run_hashes():
    words = np.random.default_rng(0).integers(0, 1 << 63, 90, dtype=np.uint64)
    words[50:70] = words[10:30]
    with warnings.catch_warnings():
        warnings.simplefilter("error")
        for n in (1, 2, 5, 11, 20):
            found = passages.run_hashes(words, n)
            assert len(found) == 91 - n and found[50] == found[10] and len(set(found[:31].tolist())) == 31


def test_pieces_in_early_documents_hide_nothing(table):
    rng = random.Random(1)
    whole = prose(rng, 60)
    texts = {i: [*prose(rng, 30), *whole[a : a + 22], *prose(rng, 30)] for i, a in zip((1, 2, 3, 4), (0, 13, 26, 38))}
    texts |= {i: [*prose(rng, 25), *whole, *prose(rng, 25)] for i in (10, 11)}
    # the same with longer pieces, before and between the two
    other = prose(rng, 70)
    texts |= {i: [*prose(rng, 9), *other[a : a + 45], *prose(rng, 9)] for i, a in zip((20, 21, 23, 24), (0, 8, 16, 25))}
    texts |= {i: [*prose(rng, 9), *other, *prose(rng, 9)] for i in (22, 25)}
    docs = table("doc_id BIGINT, text STRING", *[(i, " ".join(w)) for i, w in texts.items()])
    found = passages.repeated_passages(docs).collect()
    check(texts, found)
    assert {(11, 10, 60), (25, 22, 70)} <= {(r.doc_id, r.source_id, r.words) for r in found}
    assert named(found) == {10, 11, 22, 25}


def test_edited_passages_whose_seeds_belong_to_others(table):
    rng = random.Random(5)
    whole, texts = prose(rng, 120), {}
    for i, a in enumerate(range(0, 108, 12)):  # owners of all seeds, each with a piece
        texts[i] = [*prose(rng, 30), *whole[max(a - 8, 0) : a + 20], *prose(rng, 30)]
    for i in (50, 51, 52):  # no 25 words in a row are equal
        copy = [f"edit{i}x{k}" if k % 24 == 4 * (i - 50) else w for k, w in enumerate(whole)]
        texts[i] = [*prose(rng, 20 + i - 50), *copy, *prose(rng, 20)]
    docs = table("doc_id BIGINT, text STRING", *[(i, " ".join(w)) for i, w in texts.items()])
    found = passages.repeated_passages(docs).collect()
    check(texts, found)
    assert {(51, 50), (52, 50), (52, 51)} == {(r.doc_id, r.source_id) for r in found}


@pytest.mark.parametrize("seed", [0, 1, 2])
def test_recall_against_all_pairs(table, seed):
    rng = random.Random(seed)
    stock = [prose(rng, 120) for _ in range(6)]
    texts, fuzzy = {}, set()
    for i in range(90):
        words = prose(rng, rng.randint(0, 40))
        for _ in range(rng.randint(0, 3)):
            source, n = rng.choice(stock), rng.choice([15, 25, 40, 48, 49, 50, 51, 60, 100])
            a = rng.randrange(len(source) - n + 1)
            words += [*source[a : a + n], *prose(rng, rng.randint(1, 30))]
        texts[i] = words
    for i in range(90, 110):  # edited copies of a passage that nobody has unedited
        if i % 2 == 0:
            base = prose(rng, 100)
        copy = [w if rng.random() > 0.04 else "edited" for w in base]
        texts[i] = [*prose(rng, 20), *copy, *prose(rng, 20)]
        fuzzy.add(i)
    docs = table("doc_id BIGINT, text STRING", *[(i, " ".join(w)) for i, w in texts.items()])
    found = passages.repeated_passages(docs).collect()
    check(texts, found)
    every = {i: runs(w) for i, w in texts.items()}
    repeated = {i for i in every if any(every[i] & every[j] for j in every if j != i)}
    assert len(repeated) > 20 and not repeated - named(found)
    assert len(fuzzy & named(found)) >= 0.9 * len(fuzzy)


def edited_copies(rng, n):
    """Copies of a passage, each edited elsewhere, whose seeds belong to documents with pieces of it."""
    whole, texts = prose(rng, 120), {}
    for i, a in enumerate(range(0, 108, 12)):
        texts[i] = [*prose(rng, 30), *whole[max(a - 8, 0) : a + 20], *prose(rng, 30)]
    for i in range(50, 50 + n):
        edits = {k + rng.randrange(6) for k in range(0, 120, 24)}
        texts[i] = [*prose(rng, 20), *[f"edit{i}x{k}" if k in edits else w for k, w in enumerate(whole)], *prose(rng, 20)]
    return texts


def test_passages_of_edited_copies_grow_with_their_number(table):
    texts = edited_copies(random.Random(7), 120)
    docs = table("doc_id BIGINT, text STRING", *[(i, " ".join(w)) for i, w in texts.items()])
    found = passages.repeated_passages(docs).collect()
    check(texts, found)
    assert set(range(50, 170)) <= named(found)
    assert len({(r.doc_id, r.source_id) for r in found}) < 120 * 30  # of 7,140 pairs


def test_a_short_line_that_stands_twice_makes_no_pairs(spark, table, monkeypatch):
    rng, pairs = random.Random(11), []
    line = prose(rng, 13)
    texts = {i: [*line, *prose(rng, 17 + i), *line, *prose(rng, 30)] for i in range(40)}
    whole = prose(rng, 90)
    texts |= {i: [*prose(rng, i), *whole[: 40 + i % 2], *prose(rng, 4), *whole[44:]] for i in (100, 101)}
    docs = table("doc_id BIGINT, text STRING", *[(i, " ".join(w)) for i, w in texts.items()])
    chains = passages.chains_of

    def counted(links):
        pairs.append(links.select("doc", "owner").distinct().count())
        return chains(links)

    monkeypatch.setattr(passages, "chains_of", counted)
    found = passages.repeated_passages(docs).collect()
    check(texts, found)
    assert named(found) == {100, 101} and sum(pairs[2:]) < 250  # of 780


def test_a_few_heads_name_the_documents_that_all_pairs_name(table, monkeypatch):
    texts = edited_copies(random.Random(3), 20)
    docs = table("doc_id BIGINT, text STRING", *[(i, " ".join(w)) for i, w in texts.items()])
    some = named(passages.repeated_passages(docs).collect())
    monkeypatch.setattr(passages, "HEADS", (None,))
    assert some == named(passages.repeated_passages(docs).collect())


def test_only_texts_with_a_chain_are_fetched(table):
    ids = [0, 5, -1, -(1 << 63), (1 << 20) + 7, 1 << 40, 3]
    named = table("doc BIGINT, words BINARY", *[(i, np.arange(4, dtype="<u4").tobytes()) for i in [*ids, 6, 7, 1 << 21]])
    found = passages._codes_of(named, table("doc BIGINT", *[(i,) for i in ids[:-1]])).collect()
    assert {r.doc for r in found} == {*ids[:-1]} and all(len(r.codes) == 8 for r in found)
