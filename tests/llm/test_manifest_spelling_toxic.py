"""Merkle manifest, spelling variants and toxic spans against brute force and on odd tables."""
import hashlib
import itertools
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.llm import merkle, spellings, toxic_spans
from test_texts import DOCS, ODD, frame


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute_leaf(row, add=0):
    out = []
    for name in merkle.FIELDS:
        value = row[name]
        if name == "n_chars" and value is not None:
            value += add
        out.append("-" if value is None else f"{len(str(value).encode())}:{value}")
    return sha("".join(out))


def brute_tree(leaves):
    """Top of the leaves and, per leaf, (sibling, whether it stands on the left) level by level."""
    paths, under = [[] for _ in leaves], [[i] for i in range(len(leaves))]
    while len(leaves) > 1:
        pairs = [range(i, min(i + 2, len(leaves))) for i in range(0, len(leaves), 2)]
        for pair in pairs:
            for mine in pair:
                other = [leaves[x] for x in pair if x != mine]
                for leaf in under[mine]:
                    paths[leaf].append((other[0] if other else None, other != [] and mine % 2 == 1))
        leaves = [sha("".join(leaves[x] for x in pair)) for pair in pairs]
        under = [sum((under[x] for x in pair), []) for pair in pairs]
    return leaves[0], paths


def brute_manifest(rows):
    by_lang = defaultdict(list)
    for r in rows:
        by_lang[r["lang"]].append(r)
    langs = sorted(by_lang, key=lambda x: (x is not None, (x or "").encode()))
    order = {x: sorted(by_lang[x], key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, brute_leaf(r))) for x in langs}
    trees = {x: brute_tree([brute_leaf(r) for r in order[x]]) for x in langs}
    root, upper = brute_tree([trees[x][0] for x in langs])
    out = Counter()
    for x, on in zip(langs, upper):
        for r, path in zip(order[x], trees[x][1]):
            tampered = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 7 == 0
            h = brute_leaf(r, 1 if tampered else 0)
            for sibling, left in path + on:
                h = sha(sibling + h if left else h + (sibling or ""))
            proof = sha("".join(s for s, _ in path + on if s))
            out[r["doc_id"], brute_leaf(r), trees[x][0], root, proof, h, h == root] += 1
    return out


def manifest_rows(found):
    return Counter(tuple(r) for r in found.drop("proof").collect())


def test_manifest_equals_brute_force(spark, monkeypatch):
    """Many sizes of runs, ties, nulls; blocks of four leaves, so that tiers meet inside every run."""
    monkeypatch.setattr(merkle, "LEVELS", 2)
    rng, rows = random.Random(3), []
    for lang, n in (("en", 67), (None, 16), ("é", 17), ("zz", 1), ("", 5), ("de", 2)):
        for _ in range(n):
            i = len(rows)
            rows.append((i, f"text {i}", lang, rng.choice(["s", None]), rng.choice([3, None, 9]), "k", "w", 1))
    rows += [(None, "a", "en", "s", 1, "k", "w", 1), (3, "other", "en", "s", 1, "k", "w", 2), (7, None, "de", None, 5, "k", "w", 0)]
    rows += [rows[20]] * 3 + [(None, "a", "en", "s", 1, "k", "w", 1)]
    docs = spark.createDataFrame(rows, DOCS)
    found = merkle.manifest(docs)
    want = brute_manifest(docs.collect())
    got = manifest_rows(found)
    # Equal leaves are interchangeable: which of them has which proof is not told by the rows, but the set is.
    assert got == want and sum(got.values()) == len(rows)
    assert all(r.proof_sha256 == sha("".join(r.proof)) for r in found.collect())


def test_manifest_edges(spark):
    docs = spark.createDataFrame([(5, "x", "en", "s", 1, "k", "w", 1)], DOCS)
    row = merkle.manifest(docs).first()
    leaf = sha("1:5" + "1:s" + "2:en" + "1:1" + "1:x")
    assert (row.leaf, row.subroot, row.root, row.proof_sha256, row.verified) == (leaf, leaf, leaf, sha(""), True)
    empty = merkle.manifest(docs.limit(0))
    assert empty.count() == 0 and empty.columns == merkle.manifest(docs).columns
    clashing = docs.select(*docs.columns, F.lit(1).alias("run"), F.lit(2).alias("place"), F.lit(3).alias("node"))
    assert merkle.manifest(clashing).first().root == leaf


# Spelling variants


def brute_variants(rows, least=5):
    upper = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    counts = Counter()
    for doc, text in rows:
        run = ""
        for c in (text or "") + " ":
            if c.isascii() and c.isalpha() or "À" <= c <= "ÿ":
                run += c.translate(upper)
            elif run:
                h = zlib.crc32(f"{'null' if doc is None else doc}:{run}".encode())
                if h % 199 == 0:
                    run = run[: h % len(run)] + run[h % len(run) + 1 :]
                counts[run] += len(run) >= 6
                run = ""
    words = {w: n for w, n in counts.items() if n >= least}

    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))

    form, out = {}, set()
    neighbours = {w: [x for x in words if near(w, x)] for w in words}
    for w, n in words.items():
        best = min(((-words[x], x) for x in neighbours[w]), default=(0, None))
        form[w] = best[1] if -best[0] >= 5 * n else None
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, n, len(neighbours[w]), words.get(form[w])))
    return out


def variant_rows(found):
    return {tuple(r[c] for c in ("word", "form", "root", "n", "n_near", "form_n")) for r in found.collect()}


def test_variants_equal_brute_force(spark):
    rng = random.Random(5)
    letters = "aabbcdeéÿ"
    base = ["".join(rng.choices(letters, k=rng.randint(6, 9))) for _ in range(25)] + ["aaaaaa", "aaaaaaa", "ababab", "ðÿéÀÿß"]
    texts = []
    for i in range(220):
        out = []
        for _ in range(40):
            w = rng.choice(base[: rng.choice([1, 3, 29])])
            for _ in range(rng.choice([0, 0, 0, 1, 2])):
                p = rng.randrange(len(w) + 1)
                w = rng.choice([w[:p] + rng.choice(letters) + w[p:], w[:p] + w[p + 1 :], w[:p] + rng.choice(letters) + w[p + 1 :]])
            out.append(rng.choice([w, w.upper(), w.capitalize()]))
        texts.append((i, rng.choice([" ", "-", "1 ", "š"]).join(out)))
    texts += ODD + [(7, texts[7][1])] * 2 + [(None, "abcdefg " * 6)]
    texts += [(1000, "chainsaw " * 300 + "chainsa " * 40 + "chainse " * 5), (1001, "zzchainsaw " * 5)]
    docs = frame(spark, texts)
    got, want = variant_rows(spellings.variants(docs)), brute_variants(texts)
    assert got == want and sum(r[1] is not None for r in want) > 20
    assert any(r[2] != r[1] for r in want if r[1])  # a chain of two forms


def test_variants_of_an_empty_table(spark):
    empty = spellings.variants(frame(spark, [(1, "x")]).limit(0))
    assert empty.count() == 0 and set(empty.columns) == {"word", "form", "root", "n", "n_near", "form_n"}
    alone = spellings.variants(frame(spark, [(1, "abcdef " * 9), (2, None)])).collect()
    assert [tuple(r) for r in alone] == [("abcdef", None, "abcdef", 9, 0, None)]


# Toxic spans


@settings(max_examples=25, deadline=None)
@given(st.lists(st.integers(0, 7), min_size=1, max_size=5), st.integers(0, 10**6))
def test_chain_equals_the_sum_over_all_taggings(lengths, seed):
    rng = np.random.default_rng(seed)
    first = np.concatenate([[0], np.cumsum(lengths)])
    emission, weights = rng.normal(scale=2, size=first[-1]), np.zeros(toxic_spans.WIDTH)
    weights[toxic_spans.TRANSITIONS : toxic_spans.START + 1] = rng.normal(size=5)
    move = weights[toxic_spans.TRANSITIONS : toxic_spans.START].reshape(2, 2)
    got = toxic_spans.forward_backward(emission, first, weights)
    log_total, pairs, starts = 0.0, np.zeros(4), 0.0
    for lo, hi in zip(first, first[1:]):
        if lo == hi:
            continue
        total, marginal, steps = 0.0, np.zeros(hi - lo), np.zeros(4)
        for tags in itertools.product((0, 1), repeat=hi - lo):
            joined = list(zip(tags, tags[1:]))
            p = np.exp(weights[toxic_spans.START] * tags[0] + emission[lo:hi] @ tags + sum(move[a, b] for a, b in joined))
            total, marginal = total + p, marginal + p * np.array(tags)
            for a, b in joined:
                steps[2 * a + b] += p
        assert np.allclose(got.marginal[lo:hi], marginal / total)
        log_total, pairs, starts = log_total + np.log(total), pairs + steps / total, starts + marginal[0] / total
    assert np.isclose(got.log_total, log_total) and np.allclose(got.pairs, pairs) and np.isclose(got.starts, starts)


def test_long_chains_do_not_depend_on_lanes(monkeypatch):
    rng = np.random.default_rng(2)
    first = np.array([0, 3, 3, 1000, 1400])
    emission, weights = rng.normal(scale=3, size=1400) - 2, np.zeros(toxic_spans.WIDTH)
    weights[toxic_spans.TRANSITIONS : toxic_spans.START + 1] = [1, -2, -1, 2, -1]
    one = toxic_spans.forward_backward(emission, first, weights)
    monkeypatch.setattr(toxic_spans, "LANE", 32)
    two = toxic_spans.forward_backward(emission, first, weights)
    assert np.allclose(one.marginal, two.marginal) and np.isclose(one.log_total, two.log_total)


def toxic_table(spark, n=400):
    rng = random.Random(4)
    plain, bad = [f"word{i}" for i in range(200)], ["grrble", "snarkel", "vexling"]
    texts, labels, where = [], [], {}
    for i in range(n):
        toxic = rng.random() < 0.25
        out = rng.choices(plain, k=rng.randint(5, 80))
        if toxic:
            for _ in range(rng.randint(1, 3)):
                out.insert(rng.randrange(len(out) + 1), rng.choice(bad))
        text = "é " + " ".join(out) + " ü"
        texts.append((i, text))
        labels.append((i, 1, int(toxic)))
        where[i] = {w for w in out if w in bad}
    return texts, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), where


def test_toxic_documents_and_spans_are_found(spark):
    texts, labels, where = toxic_table(spark)
    text = dict(texts)
    got = toxic_spans.scored(frame(spark, texts + ODD), labels).collect()
    assert len(got) == len(texts) + len(ODD) and all(0 <= r.score <= 1 for r in got)
    for r in got:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert r.predicted == int(r.score >= 0.5)
    known = [r for r in got if r.doc_id in where]
    wrong = [r.doc_id for r in known if r.predicted != bool(where[r.doc_id])]
    assert len(wrong) <= 2
    for r in known:
        found = {text[r.doc_id][a:b] for a, b in r.spans}
        assert set(" ".join(found).split()) == where[r.doc_id] or r.doc_id in wrong
    twins = toxic_spans.scored(frame(spark, texts + [(9000, texts[0][1]), (9001, texts[0][1])]), labels).collect()
    assert len({round(r.score, 9) for r in twins if r.doc_id in (0, 9000, 9001)}) == 1


def test_labels_of_held_out_rows_teach_nothing(spark):
    texts, labels, _ = toxic_table(spark, 200)
    flipped = labels.withColumn(
        "toxic", F.when(toxic_spans.remainder(F.col("doc_id")) == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    one = {r.doc_id: r.score for r in toxic_spans.scored(frame(spark, texts), labels).collect()}
    two = {r.doc_id: r.score for r in toxic_spans.scored(frame(spark, texts), flipped).collect()}
    assert all(abs(one[i] - two[i]) < 1e-6 for i in one)


def test_toxic_without_usable_labels(spark):
    docs = frame(spark, [(1, "a b c"), (2, None), (None, "")])
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {(r.score, r.predicted) for r in toxic_spans.scored(docs, none).collect()} == {(0.0, 0)}
    clean = spark.createDataFrame([(1, 1, 0), (2, 1, 0), (None, 1, 1), (3, 1, None)], "doc_id long, quality int, toxic int")
    assert {r.score for r in toxic_spans.scored(docs, clean).collect()} == {0.0}
    assert toxic_spans.scored(docs.limit(0), clean).count() == 0


def test_offsets_are_code_points():
    texts = pa.array(["é bad bad x", "", "🙂 bad"])  # a character beyond ASCII is a word's
    found = toxic_spans.tokens(texts)
    offsets = toxic_spans.words.text_bytes(texts)[1]
    text, start, end = toxic_spans._spans(found, np.array([0, 0.9, 0.8, 0, 0, 0.7]), offsets, 0.5)
    assert list(zip(text.tolist(), start.tolist(), end.tolist())) == [(0, 2, 9), (2, 2, 5)]
