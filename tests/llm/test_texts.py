"""Language, near-duplicate, decontamination, quality, line, licence and page operators on small texts."""
import itertools
import random
import re
import time
import zlib

import numpy as np
import pyarrow as pa
import pytest
from conftest import SF
from pyspark.sql import functions as F

from millrace.llm import lang_pieces, licences, line_windows, main_text, order_minhash, quality, spaced_seeds, words

DOCS = "doc_id long, text string, lang string, source string, n_chars long, _key string, words string, at int"
VOCABULARY = [f"w{i}" for i in range(400)]
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def prose(seed: int, n: int) -> list[str]:
    return random.Random(seed).choices(VOCABULARY, k=n)


def frame(spark, texts, langs=None):
    rows = [(i, t, (langs or {}).get(i, "en"), "s", None, "x", "y", 1) for i, t in texts]
    return spark.createDataFrame(rows, DOCS)


def split(text):
    return WORD.findall((text or "").translate(LOWER))


ODD = [(None, "no id"), (900, None), (901, ""), (902, "!!! ... 123"), (903, "one"), (904, "\x00 ퟿ \U0001f600"), (905, "a" * 3000)]


def test_words_are_found_and_hashed_alike():
    texts = ["Hello, World! hello", "", None, "été ÉTÉ x1", "a" * 50, "tail"]
    found = words.hashed_words(pa.array(texts))
    flat = [w for t in texts for w in split(t)]
    assert np.diff(found.first).tolist() == [len(split(t)) for t in texts]
    pairs = itertools.combinations(range(len(flat)), 2)
    assert all((flat[i] == flat[j]) == (found.hashes[i] == found.hashes[j]) for i, j in pairs)


def test_long_texts_are_cut_between_words():
    text = " ".join(prose(1, 300_000))
    found = words.hashed_words(pa.array(["x", text]))
    assert np.diff(found.first).tolist() == [1, 300_000]
    again = words.hashed_words(pa.array([text[-1000:].split(" ", 1)[1]]))
    assert (found.hashes[-len(again.hashes):] == again.hashes).all()


def brute_similarity(a, b):
    def labelled(t):
        w, seen, out = split(t), {}, []
        for g in [tuple(w[i : i + 5]) for i in range(len(w) - 4)] or ([tuple(w)] if w else []):
            seen[g] = seen.get(g, 0) + 1
            out.append((g, seen[g]))
        return out
    x, y = labelled(a), labelled(b)
    if not x or not y:
        return 0.0
    row = [0] * (len(y) + 1)
    for p in x:
        last = row[:]
        for j, q in enumerate(y):
            row[j + 1] = last[j] + 1 if p == q else max(last[j + 1], row[j])
    return row[-1] / (len(x) + len(y) - row[-1])


def brute_groups(texts):
    usable = [(i, t) for i, t in texts if i is not None and split(t)]
    parent = {i: i for i, _ in usable}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for (i, t), (j, u) in itertools.combinations(usable, 2):
        if root(i) != root(j) and brute_similarity(t, u) >= 0.8:
            a, b = sorted((root(i), root(j)))
            parent[b] = a
    return {i: root(i) for i in parent}


def copies():
    texts = []
    for g in range(6):
        base = prose(g, 120)
        for k in range(8):
            rng, w = random.Random(g * 100 + k), base[:]
            for _ in range(k % 4):
                w[rng.randrange(len(w))] = "changed" + str(rng.randrange(9))
            texts.append((g * 10 + k, " ".join(w)))
    texts += [(100 + i, " ".join(prose(50 + i, 40))) for i in range(10)]
    texts += [(200, "Alpha beta"), (201, "alpha, BETA"), (202, "alpha beta gamma"), (203, " ".join(prose(3, 120)[::-1]))]
    return texts


def test_near_duplicates_match_brute_force(spark):
    texts = copies() + ODD
    got = {r["doc_id"]: r for r in order_minhash.near_duplicates(frame(spark, texts)).collect()}
    want = brute_groups(texts)
    assert {i: got[i]["component_id"] for i in want} == want
    assert all(r["kept"] == (i is None or r["component_id"] == i) for i, r in got.items())
    assert len(got) == len(texts)


def test_large_group_of_near_copies_is_one_component(spark):
    base, texts = prose(9, 150), []
    for k in range(900):
        w = base[:]
        w[random.Random(k).randrange(150)] = f"v{k}"
        texts.append((k, " ".join(w)))
    assert {r["component_id"] for r in order_minhash.near_duplicates(frame(spark, texts)).collect()} == {0}


def test_one_of_each_keeps_columns_and_one_repeated_row(spark):
    docs = frame(spark, [(1, "a b c d e f g"), (1, "a b c d e f g"), (2, "A b c d e f g"), (3, "other words here"), (None, "x y")])
    out = order_minhash.one_of_each(docs)
    assert out.columns == docs.columns
    assert sorted((r["doc_id"] or -1) for r in out.collect()) == [-1, 1, 3]
    assert order_minhash.one_of_each(docs.limit(0)).count() == 0


def test_masks_survive_two_substitutions():
    for hurt in itertools.combinations(range(spaced_seeds.OVERLAP), 2):
        assert any(
            all(bit == "0" or at + k not in hurt for k, bit in enumerate(mask))
            for mask in spaced_seeds.MASKS for at in range(spaced_seeds.OVERLAP - len(mask) + 1))


def brute_overlap(text, item):
    x, y = split(text.lower() if text else ""), split(item.lower() if item else "")
    n = min(13, len(y))
    if not y:
        return False
    return any(
        sum(x[i + k] == y[j + k] for k in range(n)) >= -(-n * 8 // 10)
        for i in range(len(x) - n + 1) for j in range(len(y) - n + 1))


def test_overlaps_match_brute_force(spark):
    items = [(i, " ".join(prose(1000 + i, 20 + i))) for i in range(8)] + [(50, None), (51, "too short"), (52, "six words that stand for themselves")]
    texts = []
    for k in range(60):
        rng, w = random.Random(k), prose(k, 60)
        src = items[k % 8][1].split()
        size = rng.randrange(8, 20)
        part = src[:size]
        for _ in range(k % 4):
            part[rng.randrange(len(part))] = "other"
        texts.append((k, " ".join(w[:20] + part + w[20:])))
    texts += [(70, "so six words that stand for themselves end"), (71, items[0][1].upper()), (72, items[1][1]), (72, items[1][1])] + ODD
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = spaced_seeds.contaminated(frame(spark, texts), bench).collect()
    assert len(got) == len(texts)
    want = {(i, tuple(sorted(k for k, t in items if brute_overlap(text, t)))) for i, text in texts}
    assert {(r["doc_id"], tuple(r["items"])) for r in got} == want
    assert all(r["contaminated"] == bool(r["items"]) for r in got)
    clean = spaced_seeds.clean(frame(spark, texts), bench)
    assert clean.columns == frame(spark, texts).columns
    assert clean.count() == sum(not any(brute_overlap(t, i) for _, i in items) for _, t in texts)
    assert spaced_seeds.clean(frame(spark, texts), bench.limit(0)).count() == len(texts)


def test_short_items_are_found_under_all_allowed_substitutions(spark):
    items = [(n, " ".join(f"i{n}x{k}" for k in range(n))) for n in range(1, 13)]
    texts = []
    for n, item in items:
        w = item.split()
        for count in (n // 5, n // 5 + 1):
            for hurt in itertools.combinations(range(n), count):
                part = ["other" if k in hurt else x for k, x in enumerate(w)]
                around = prose(len(texts), 6) if len(texts) % 3 else []
                texts.append((len(texts), " ".join(around[:3] + part + around[3:])))
    got = spaced_seeds.contaminated(frame(spark, texts), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {r["doc_id"]: r["items"] for r in got} == {i: [k for k, t in items if brute_overlap(text, t)] for i, text in texts}
    assert sum(r["contaminated"] for r in got) == 4 + 5 + 6 + 7 + 8 + 9 + 45 + 55 + 66


def test_language_lattice_sums_all_cuts():
    lattice = lang_pieces.Lattice(["a", "b", "ab", "ba", "aba"])
    p = np.array([[0, 0], [0.01, 0.02], [0.3, 0.1], [0.2, 0.2], [0.1, 0.3], [0.2, 0.1], [0.1, 0.2]])
    number = {"a": 2, "b": 3, "ab": 4, "ba": 5, "aba": 6}

    def total(word, lang):
        if not word:
            return 1.0
        out = sum(p[number[word[:k]], lang] * total(word[k:], lang) for k in range(1, len(word) + 1) if word[:k] in number)
        return out + (p[1, lang] * total(word[1:], lang) if word[0] not in number else 0)
    some = ["aba", "b", "abab", "axb", "z"]
    got = lattice.log_likelihood(some, p)
    assert np.allclose(np.exp(got), [[total(w, 0), total(w, 1)] for w in some])
    counts = lattice.expected(["ab"], np.array([[1.0]]), p[:, :1])
    both, cut = p[4, 0], p[2, 0] * p[3, 0]
    assert np.allclose(counts[0, [2, 3, 4]], [cut / (both + cut), cut / (both + cut), both / (both + cut)])


def test_language_held_out_accuracy_and_odd_texts(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = lang_pieces.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out")
    right = got.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0]
    assert right >= 0.95
    odd = {r["doc_id"]: r for r in lang_pieces.identify(frame(spark, ODD)).collect()}
    assert [odd[i]["lang_pred"] for i in (900, 901, 902, 904)] == ["und"] * 4
    assert all(0 <= r["score"] <= 1 for r in odd.values()) and len(odd) == len(ODD)
    numbers = lang_pieces.identify(frame(spark, [(1, "²③½ Ⅷ 12 ٣"), (2, "a ②"), (3, "ª")]), lang_pieces.train(docs)).collect()
    assert [(r["lang_pred"] == "und", r["score"] == 0) for r in sorted(numbers, key=lambda r: r["doc_id"])] == [
        (True, True), (False, False), (False, False)]
    kept = lang_pieces.identified(frame(spark, ODD))
    assert {r["doc_id"] for r in kept.collect()} == {None, 903, 905} and kept.columns == DOCS.replace(",", "").split()[::2]
    assert lang_pieces.identify(docs.limit(0)).count() == 0
    assert {r["held_out"] for r in lang_pieces.identify(docs).where("doc_id % 7 = 0").select("held_out").collect()} <= {True, False}


def test_quality_held_out_accuracy_and_odd_texts(spark):
    sf = SF.replace("0.001", "0.01")
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    got = quality.scored(docs, labels)
    held = got.join(labels, "doc_id").where("held_out")
    assert held.agg(F.avg((F.col("predicted") == F.col("quality")).cast("double"))).first()[0] >= 0.95
    assert got.where("score < 0 OR score > 1 OR predicted <> cast(score >= 0.5 AS int)").count() == 0
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in got.limit(50).collect())
    odd = quality.scored(frame(spark, ODD), labels.limit(0)).collect()
    assert len(odd) == len(ODD) and all(r["score"] == 0.5 for r in odd)
    assert quality.scored(frame(spark, []), labels.limit(0)).count() == 0


def test_isotonic_levels_do_not_fall():
    levels = quality.isotonic(np.arange(6), np.array([0, 3, 1, 2, 5, 4]), np.full(6, 5))
    assert (np.diff(levels) >= 0).all() and 0 < levels[0] and levels[-1] < 1


def test_line_windows(spark):
    passage = ["one line", "  two line ", "three line", "four line"]
    texts = [
        (1, "\n".join(["start", *passage, "end"])), (2, "\n".join([*passage[:2], "", *passage[2:], "own"])), (3, "a\nb"),
        (4, "\n".join(passage[:2])), (5, None), (6, ""), (7, "x\ny\nz\nx\ny\nz"), (None, "p\nq\nr"), (8, "p\nq\nr")]
    got = {r["doc_id"]: r for r in line_windows.without_repeats(frame(spark, texts)).collect()}
    assert got[1]["text"] == texts[0][1] and got[1]["n_removed"] == 0
    assert got[2]["text"] == "own" and got[2]["n_removed"] == 5 and got[2]["n_lines"] == 6
    assert got[3]["text"] == "a\nb" and got[4]["text"] == texts[3][1]
    assert got[5]["text"] is None and got[5]["n_lines"] is None and got[6]["text"] == ""
    assert got[7]["text"] == "x\ny\nz"
    assert got[None]["text"] == "p\nq\nr" and got[8]["text"] == ""
    assert line_windows.without_repeats(frame(spark, [])).count() == 0


def test_licences_match_brute_force(spark):
    lines = ["Released under the MIT License.", "Licensed under the Apache License, Version 2.0.", "CC BY-NC 4.0", "under the mit licenses",
             "This work is licensed under the GNU General Public License, version 3.", "apache license version 2 cc by nc"]
    texts = [(i, " ".join(prose(i, 30) + [lines[i % 6]] + prose(i + 99, 9) + [lines[(i * 5) % 6]])) for i in range(40)] + ODD
    got = {r["doc_id"]: r for r in licences.scan(frame(spark, texts)).collect()}
    for i, text in texts:
        w, starts, labels = split(text), [], set()
        for phrase, label in licences.PHRASES.items():
            p = phrase.split()
            here = [k for k in range(len(w)) if w[k : k + len(p)] == p]
            starts += here
            labels |= {label} if here else set()
        r = got[i]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"]) == (len(w), len(starts), min(starts, default=None), max(starts, default=None))
        assert r["base_labels"] == ",".join(sorted(labels)) and labels <= set(r["labels"].split(","))
        assert ("gpl" in r["labels"].split(",")) == ("gnu general public license" in " ".join(w))
        assert 0 <= r["score"] <= 1 and (r["score"] > 0) == bool(r["labels"])
    assert licences.scan(frame(spark, [])).count() == 0


PAGES = [
    (None, ""), ("", ""), ("<p>just text", "just text"),
    ("<html><head><title>t</title><style>p{}</style></head><body><nav><a href=/>Home</a></nav><div class='ad box'>Buy the thing</div>"
     "<article><h1>Short &amp; sweet</h1><p>A  first\n line.<br>And <b>bo<i>ld</i></b>.<p>Second &lt;p&gt;.</article>"
     "<aside>more</aside><form><input><p>mail</form><section id=comments><p>I liked it</p></section><footer>&copy; x</footer></body>",
     "Short & sweet A first line. And bold. Second <p>."),
    ("<article><header><h1>Title</h1></header><p>Body text</p><div class=\"share-buttons\"><p>Share</p></div><script>if (a<b) x('</p>')</script><p>End &eacute;&#233;&#xE9;</p></article>", "Title Body text End ééé"),
    ("<header><p>Site</p></header><main><p>In &nbsp; main</p><div role=navigation><p>next</p></div></main><div id='cookieNotice'>We use cookies</div>", "In main"),
    ("<body><div><a href=a>one</a> <a href=b>two</a></div><p>" + "The house that is in the wood was not for us and it is old. " * 3 + "</p><p>Short end</p></body>",
     ("The house that is in the wood was not for us and it is old. " * 3).strip()),
    ("a < b and <unclosed", "a < b and <unclosed"), ("<p>before <a href=x", "before"), ("<p>x<3 <b", "x<3"),
    ("<p title=it's>A</p><p>B</p><p title=that's>C</p>", "A B C"), ("<p>1 <b class=x/>bold</b> <i title = \"a>b\">it</i></p>", "1 bold it"),
    ("<article><p>some text here and <a href=\"x\"\">a link</a> with more words behind it</p>", "some text here and a link with more words behind it"),
    ("<section class=\"related-work\"><p>Prose</p></section><div class='post-header hidden-xs'>Head</div><div class='siteFooter'>f</div>"
     "<div class='x sidebar-left'>g</div><div class=comment-list>h</div>", "Prose Head"),
    ("<svg/onload=x>t</svg><scripty>kept</scripty>", "kept"),
]


@pytest.mark.parametrize("page, want", PAGES)
def test_main_text_of_a_page(page, want):
    assert main_text.extract(page) == want


@pytest.mark.parametrize("unit", ["<b>x ", "<a ", '<a x="', "<p>x ", "</b", "< ", "<div><a>", "<x y='", "<u", "<i>z</b>"])
def test_pages_of_a_megabyte_take_linear_time(unit):
    took = []
    for size in (100_000, 1_000_000):
        began = time.perf_counter()
        main_text.extract((unit * (size // len(unit) + 1))[:size])
        took.append(time.perf_counter() - began)
    assert took[1] < 2 and took[1] < 40 * max(took[0], 0.005)


PROSE = "The house that is in the wood was not for us and it is old. " * 4
ITALIAN = "Nel mezzo del cammin di nostra vita mi ritrovai per una selva oscura, quanto a dir qual era cosa dura esta selva selvaggia. " * 2
RUSSIAN = "Все счастливые семьи похожи друг на друга, каждая несчастливая семья несчастлива по-своему. " * 2
CHINESE = "道可道,非常道。名可名,非常名。無名天地之始;有名萬物之母。故常無欲以觀其妙。" * 2
CODE = "int main(void) { printf(value); return 0; } struct node { struct node *next; int key; };"
LINKED = "<div><a href=a>First link of a list</a> <a href=b>second link of a list</a></div>"


@pytest.mark.parametrize("page, want", [
    (f"{LINKED}<div>{PROSE}</div><div>{PROSE}</div><article><a href=x>Read this too</a></article>", [PROSE, PROSE]),
    (f"<div>{PROSE}</div><div>{PROSE}</div><article><h3>Teaser</h3><p>Short teaser</p></article>{LINKED}", [PROSE, PROSE]),
    *[(f"{LINKED}<p>{x}</p><p>{x}</p>{LINKED}", [x, x]) for x in (ITALIAN, RUSSIAN, CHINESE, CODE)],
    (f"{LINKED}<p>{PROSE}</p><pre>{CODE}</pre><p>{PROSE}</p>{LINKED}", [PROSE, CODE, PROSE]),
    (f"<article><p>{RUSSIAN}</p><p>Short</p></article>{LINKED}", [RUSSIAN, "Short"]),
])
def test_main_text_beside_teasers_and_in_other_languages(page, want):
    assert main_text.extract(page) == " ".join(" ".join(x.split()) for x in want)


def test_main_text_frame(spark):
    rows = [(i, f"u{i}", p) for i, (p, _) in enumerate(PAGES)] + [(None, None, "<p>x")]
    got = main_text.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert [r["text"] for r in sorted(got[:-1], key=lambda r: r["page_id"])] == [w for _, w in PAGES]
    assert all(r["n_chars"] == len(r["text"]) for r in got)
