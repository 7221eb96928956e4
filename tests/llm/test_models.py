import math
import random
import zlib
from collections import Counter

import brute
import numpy as np
import pyarrow as pa
import pytest

from quipyard.llm import suffix_tree_lm, toxicity


def labelled(n=1500, seed=1):
    """Texts with insults, and texts on a group that are more often toxic than not."""
    pick, rows = random.Random(seed), []
    for i in range(n):
        toxic = pick.random() < 0.4
        words = pick.choices([f"word{k}" for k in range(200)], k=pick.randint(5, 60))
        if toxic and pick.random() < 0.6:
            words += pick.choices(["idiotic", "scummy", "moronic"], k=2)
        if pick.random() < (0.7 if toxic else 0.05):
            words.append("muslims")
        if pick.random() < 0.2:
            words.append("christians")
        pick.shuffle(words)
        rows.append((i, " ".join(words).title(), int(toxic)))
    return rows


def tables(table, rows):
    docs = table("doc_id BIGINT, text STRING, score STRING, toxic STRING", *[(i, t, "x", "y") for i, t, _ in rows])
    labels = table("doc_id BIGINT, quality INT, toxic INT", *[(i, None, y) for i, _, y in rows])
    return docs, labels


def test_counterfactuals_reduce_false_positives(table):
    docs, labels = tables(table, labelled())
    neutral = pa.array([f"muslims pray word{i} word{i + 1}" for i in range(50)])
    plain = toxicity.train(docs, labels, fairness=0).scores(neutral)
    fair = toxicity.train(docs, labels, fairness=10.0)
    assert fair.scores(neutral).mean() < plain.mean() - 0.2
    change = fair.scores(pa.array(["muslims word1", "christians word1"]))
    assert abs(change[0] - change[1]) < 0.1
    insults = pa.array([f"word{i} idiotic word3 scummy word5 word6" for i in range(50)])
    assert (fair.scores(insults) >= 0.5).all()


def test_scores_of_any_text(table):
    docs, labels = tables(table, labelled(200))
    model = toxicity.train(docs, labels)
    odd = table("doc_id BIGINT, text STRING, held_out STRING", (1, None, "x"), (None, "", "x"), (5, "idiotic scummy " * 20_000, "x"), (5, "hello", "x"), (5, "hello", "x"))
    rows = toxicity.score_documents(odd, model).collect()
    assert len(rows) == 5 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    assert {(r.doc_id, r.held_out) for r in rows} == {
        (1, zlib.crc32(b"1") % 5 == 0), (None, True), (5, zlib.crc32(b"5") % 5 == 0)
    }
    kept = toxicity.drop_toxic(odd, model)
    assert kept.columns == odd.columns and kept.count() == sum(r.predicted == 0 for r in rows) == 4
    assert toxicity.score_documents(odd.filter("false"), model).count() == 0


def test_without_labels(table):
    docs, labels = tables(table, labelled(20))
    model = toxicity.train(docs, labels.filter("false"))
    assert toxicity.score_documents(docs, model).filter("abs(score - 1 / 3) > 1e-9").count() == 0


def test_held_out_labels_never_teach(table):
    rows = labelled(300)
    turned = [(i, t, 1 - y if zlib.crc32(str(i).encode()) % 5 == 0 else y) for i, t, y in rows]
    a, b = (toxicity.train(*tables(table, r)) for r in (rows, turned))
    assert a == b


def tree_by_definition(docs):
    """Scores by dictionaries of counts."""
    lm = suffix_tree_lm
    tokens = [[*(t or "").lower().split(), "\n"] for _, t in docs]
    training = [w for (i, _), w in zip(docs, tokens) if zlib.crc32(("" if i is None else str(i)).encode()) % 7 != 2]
    c = Counter(x for w in training for x in w)
    total, distinct = sum(c.values()), len(c)
    root = lambda w: (c[w] + 1) / (total + distinct + 1)
    frequent = {w for w in c if c[w] >= max(1, lm.FREQUENT * total)}
    least, joint = max(lm.SEEN, lm.CONTEXT * total), max(1, lm.JOINT * total)
    letters = {w for w in c if c[w] >= least}
    sizes, entries, levels = {(w,): c[w] for w in letters}, {}, []

    def gain(s):
        below = lambda w: entries[s[1:]][w] / sizes[s[1:]] if s[1:] else root(w)
        return sum(n / sizes[s] * math.log(n / sizes[s] / below(w)) for w, n in entries[s].items())

    level = set(sizes)
    while level:
        length = len(next(iter(level)))
        follow = Counter()
        for w in training:
            follow.update((tuple(w[k : k + length]), w[k + length]) for k in range(len(w) - length))
        entries |= {s: {} for s in level}
        for (s, w), n in follow.items():
            if s in level and w in frequent and n >= joint:
                entries[s][w] = n
        good = {s for s in level if gain(s) >= lm.DIVERGENCE}
        if length > 2 and not good:
            break
        levels.append(good)
        longer = {(*s, w): n for s in level for w, n in entries[s].items() if n >= least and w in letters}
        sizes |= longer
        level = set(longer)
    nodes = {s[k:] for good in levels for s in good for k in range(len(s))}

    def behind(s, w):
        if not s:
            return root(w)
        if s not in nodes:
            return behind(s[1:], w)
        own = {x: max(n - lm.DISCOUNT, 0) / sizes[s] for x, n in entries[s].items()}
        return own.get(w, 0) + (1 - sum(own.values())) * behind(s[1:], w)

    longest = len(levels)
    scores = [sum(math.log10(behind(tuple(w[max(0, k - longest) : k]), x)) for k, x in enumerate(w)) for w in tokens]
    base = [sum(math.log10(root(x)) for x in w) for w in tokens]
    return total, tokens, [sum(c[x] > 0 for x in w) for w in tokens], base, scores, max(map(len, nodes))


@pytest.mark.parametrize("shares", [(5e-7, 1e-5, 1e-6, 3), (0.004, 0.01, 0.002, 1), (0.0, 0.001, 0.0, 5)])
def test_tree_equals_its_definition(table, monkeypatch, shares):
    for name, share in zip(("FREQUENT", "CONTEXT", "JOINT", "SEEN"), shares):
        monkeypatch.setattr(suffix_tree_lm, name, share)
    pick = random.Random(3)
    words = ["the", "of", "é", "Ab", "q,"] + [f"w{i}" for i in range(60)]
    docs = [(i, " ".join(pick.choices(words, weights=[30, 20, 10, 8, 5] + [1] * 60, k=pick.randint(0, 80)))) for i in range(120)]
    docs += [(500, "the cat sat"), (500, "the cat sat"), (None, None), (501, " \n"), (502, "of the " * 3000)]
    # what follows "w1", "w1 w2", ... hangs on the word before it
    same = ["w1", "w2", "w3", "w4"]
    docs += [(600 + i, " ".join([a, *same[: 1 + i % 4], b, "w5"])) for i in range(240) for a, b in (("q,", "the"), ("é", "of"))]
    frame = table("doc_id BIGINT, text STRING, score STRING", *[(i, t, "x") for i, t in docs])
    total, tokens, known, base, scores, longest = tree_by_definition(docs)
    assert longest >= (5 if shares[1] < 0.01 else 3)
    rows = suffix_tree_lm.score_texts(frame).collect()
    key = lambda r: (str(r[0]), *[round(x, 6) for x in r[1:]])
    found = sorted(key((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score)) for r in rows)
    want = sorted(key((i, len(w), k, total, b, s)) for (i, _), w, k, b, s in zip(docs, tokens, known, base, scores))
    assert [f[:4] for f in found] == [w[:4] for w in want]
    assert np.allclose([f[4:] for f in found], [w[4:] for w in want], rtol=1e-6, atol=2e-5)
    held = [r for r in rows if r.held_out]
    assert len(held) == sum(zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in docs if i is not None)


def scores_by_definition(docs):
    """Scores with every context that stands twice, by dictionaries of counts."""
    lm = suffix_tree_lm
    tokens = [[*(t or "").lower().split(), "\n"] for _, t in docs]
    training = [w for (i, _), w in zip(docs, tokens) if zlib.crc32(("" if i is None else str(i)).encode()) % 7 != 2]
    c = Counter(x for w in training for x in w)
    mass = sum(c.values()) + len(c) + 1
    root = lambda w: (c[w] + 1) / mass
    behind, length, level = {}, 0, [(w, k) for w in training for k in range(1, len(w))]
    nodes = set()
    while level:
        length += 1
        found = {}
        for w, k in level:
            found.setdefault(tuple(w[k - length : k]), Counter())[w[k]] += 1
        found = {s: n for s, n in found.items() if sum(n.values()) >= lm.SEEN}
        behind |= found
        for s, n in found.items():
            size = sum(n.values())
            above = behind.get(s[1:])
            of = sum(above.values()) if above else 0
            if sum(m / size * math.log(m / size / (above[x] / of if above else root(x))) for x, m in n.items()) >= lm.DIVERGENCE:
                nodes |= {s[j:] for j in range(len(s))}
        level = [(w, k) for w, k in level if k > length and len(found.get(tuple(w[k - length : k]), ())) > 1]

    def score(w):
        total = 0.0
        for k, x in enumerate(w):
            p, n = root(x), 1
            while n <= k and tuple(w[k - n : k]) in nodes:
                own = behind[tuple(w[k - n : k])]
                size = sum(own.values())
                p = max(own[x] - lm.DISCOUNT, 0) / size + lm.DISCOUNT * len(own) / size * p
                n += 1
            total += math.log10(p)
        return total

    return [score(w) for w in tokens], max(map(len, nodes))


def odd_corpus(seed):
    """Near copies, texts that repeat themselves, and a context that diverges only as a whole."""
    pick = random.Random(seed)
    words = [f"w{i}" for i in range(25)]
    docs = [(i, " ".join(pick.choices(words, k=pick.randint(0, 60)))) for i in range(80)]
    for i in range(12):
        copy = docs[pick.randrange(80)][1].split()
        for _ in range(pick.randint(0, 2)):
            if copy:
                copy[pick.randrange(len(copy))] = pick.choice(words)
        docs += [(200 + i, " ".join(copy))]
    docs += [(300, "a " * 70), (301, "a " * 90), (302, "b a " * 40 + "c"), (303, "b a " * 30), (None, "w1 w2"), (304, None), (305, " ")]
    # after "y m1 ... m9" comes e1, after "z m1 ... m9" e2; shorter contexts with m9 see both, 40 times each
    middle = " ".join(f"m{i}" for i in range(1, 10))
    docs += [(400 + i, f"{first} {middle} {last}") for i in range(40) for first, last in (("y", "e1"), ("z", "e2"))]
    return docs


@pytest.mark.parametrize("lengths", [(1, 2), (2, 3), (3, 11)])
def test_every_context_that_stands_twice_counts(table, monkeypatch, lengths):
    for name, value in zip(("FIRST", "SECOND", "PART_TOKENS"), (*lengths, 1500)):
        monkeypatch.setattr(suffix_tree_lm, name, value)
    docs = odd_corpus(lengths[0])
    frame = table("doc_id BIGINT, text STRING", *docs)
    want, longest = scores_by_definition(docs)
    assert longest > 11
    rows = suffix_tree_lm.score_texts(frame).collect()
    found = sorted((str(r.doc_id), r.n_tokens, r.score) for r in rows)
    want = sorted((str(i), len((t or "").split()) + 1, s) for (i, t), s in zip(docs, want))
    assert [f[:2] for f in found] == [w[:2] for w in want]
    assert np.allclose([f[2] for f in found], [w[2] for w in want], rtol=1e-6, atol=1e-5)


def test_a_long_context_alone_diverges(table):
    """Shorter contexts leave open what follows; a common text makes their share of the corpus small."""
    middle = " ".join(f"m{i}" for i in range(1, 15))
    ids = [i for i in range(60) if zlib.crc32(str(i).encode()) % 7 != 2]
    docs = [(i, f"{'yz'[k % 2]} {middle} e{k % 2}") for k, i in enumerate(ids[:8])]
    docs += [(i, " ".join(f"t{j}x{i}" for j in range(5000))) for i in ids[8:]]
    rows = {r.doc_id: r.score for r in suffix_tree_lm.score_texts(table("doc_id BIGINT, text STRING", *docs)).collect()}
    want, longest = scores_by_definition(docs)
    assert longest == 15
    assert np.allclose([rows[i] for i in ids[:8]], want[:8], rtol=1e-6, atol=1e-5)


def test_no_training_text(table):
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)
    docs = table("doc_id BIGINT, text STRING", (held, "a b"))
    [row] = suffix_tree_lm.score_texts(docs).collect()
    assert (row.n_tokens, row.n_known, row.train_tokens, row.base_score, row.score) == (3, 0, 0, 0.0, 0.0)
    assert suffix_tree_lm.score_texts(docs.filter("false")).count() == 0


def test_pipeline_equals_its_stages_by_brute_force(spark):
    import corpus_pipeline

    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels, items = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("labels", "benchmark"))
    scored = toxicity.score_documents(docs, toxicity.train(docs, labels)).collect()
    toxic = {r.doc_id for r in scored if r.predicted}
    rows = [(r.doc_id, r.text) for r in docs.collect() if r.doc_id not in toxic]
    kept = brute.kept_of_equal(rows)
    rows = [r for i, r in enumerate(rows) if i in kept]
    roots = brute.components([brute.fingerprint(t) for _, t in rows], 4)
    heads = {}
    for (i, _), root in zip(rows, roots):
        heads[root] = min(heads.get(root, i), i)
    rows = [r for r in rows if r[0] in set(heads.values())]
    passages = [brute.words_of(r.text) for r in items.collect()]

    def leaks(text):
        words = brute.words_of(text)
        grams = {tuple(words[k : k + 5]) for k in range(len(words))}
        some = [p for p in passages if any(tuple(p[k : k + 5]) in grams for k in range(len(p) - 4))]
        return any(sum(tuple(p[k : k + 5]) in grams for k in range(len(p) - 4)) >= 0.6 * (len(p) - 4) for p in some)

    want = {i for i, t in rows if not leaks(t)}
    found = corpus_pipeline.run(spark, folder)
    assert found.columns == [*corpus_pipeline.CARRIED, "n_tokens", "ids", "decoded"]
    assert sorted(r.doc_id for r in found.collect()) == sorted(want)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs.filter("false"), folder).count() == 0


def test_training_rows_are_bounded_by_id(table):
    ids = [i for i in range(60) if zlib.crc32(str(i).encode()) % 5]
    docs = table("doc_id BIGINT, text STRING", *[(ids[0], f"text {n}") for n in range(500)], *[(i, "t") for i in ids[1:]], (None, "x"))
    labels = table("doc_id BIGINT, toxic INT", *[(i, i % 2) for i in ids])
    for most in (2, 1000):
        rows = toxicity.training_rows(docs, labels, most).collect()
        assert len(rows) == min(most, len(ids))
