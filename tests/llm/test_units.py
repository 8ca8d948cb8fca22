"""The parts of the operators that need no Spark, against plain versions."""

import collections
import itertools
import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from gridloom.llm import fingerprint, html_text, near_dup, segment, suffixes, toxicity


def test_fingerprint_of_equal_and_edited_texts():
    rng = random.Random(1)
    words = ["".join(rng.choices("abcdef", k=4)) for _ in range(2000)]
    a, b = (" ".join(rng.choices(words, k=400)) for _ in range(2))
    assert fingerprint.fingerprint(a) == fingerprint.fingerprint(a)
    assert fingerprint.likeness(fingerprint.fingerprint(a), fingerprint.fingerprint(a)) == 1
    near = fingerprint.likeness(fingerprint.fingerprint(a), fingerprint.fingerprint(fingerprint.edited(a, b)))
    far = fingerprint.likeness(fingerprint.fingerprint(a), fingerprint.fingerprint(b))
    assert 0.5 < near < 0.85 and far < 0.35
    assert fingerprint.fingerprint(None) == fingerprint.fingerprint("  ") == bytes(32)
    assert fingerprint.likeness(bytes(32), fingerprint.fingerprint(a)) == 0
    assert fingerprint.edited("abcdef", "xyz") == "abcdxy" and fingerprint.edited("abcdefghi", "x") == "abcdefx"


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p>";</script></head><body>
<nav><ul><li><a href="/a">Home</a></li></ul></nav><div class="ad">Buy the best of it and that is all for you.</div>
<article><h1>A   head &amp; more</h1><p>The first of the paragraphs is here, and it has the words that are
in most of the texts of this language.</p><div class="notice">We use cookies on this site and that is it.</div>
<p><b>Unclosed and the rest of it is the text of the page<br>goes on with it for a while and for more.<p>Short one.</p>
<!-- no --><form>Sign up for the letter</form></article>
<section id="comments"><p>I think that this is the worst of all the things that I have read.</p></section>
<footer>&copy; site &middot; all</footer></body></html>"""


def test_main_text_keeps_the_article_only():
    text, n, kept = html_text.main_text(PAGE)
    assert text.split("\n") == [
        "A head & more",
        "The first of the paragraphs is here, and it has the words that are in most of the texts of this language.",
        "Unclosed and the rest of it is the text of the page goes on with it for a while and for more.",
        "Short one.",
    ]
    assert html_text.main_text(None) == ("", 0, 0) and html_text.main_text("<nav><a>x</a>")[0] == ""
    assert html_text.main_text("<article><p>The end of it is cut in the mid &am")[0] == "The end of it is cut in the mid &am"


def test_main_text_without_an_article_takes_dense_blocks_and_their_neighbours():
    long = "This is the text of the page and it is as long as it has to be for that to be seen by the rules. " * 3
    page = f"<body><ul><li><a href=x>one link</a></li></ul><p>{long}</p><p>In short.</p><p>{long}</p><div><a href=y>more links here</a></div></body>"
    assert html_text.main_text(page)[0].split("\n") == [long.strip(), "In short.", long.strip()]


@pytest.mark.parametrize(
    "sentence",
    ["Il gatto nero dorme sopra il vecchio tetto della casa grande vicino al fiume.", "Den gamla katten sover gärna på taket av det stora huset nära floden.", "古い家の屋根の上で黒い猫が静かに眠っている。川の近くの町は朝から雨が降っている。"],
)
def test_main_text_in_languages_without_known_stop_words(sentence):
    text = " ".join([sentence] * 4)
    page = f"<body><nav><a href=x>one</a> <a href=y>two</a></nav><h1>Title</h1><p>{text}</p><p>{text}</p><div class=sidebar>{text}</div></body>"
    assert html_text.main_text(page)[0].split("\n")[-2:] == [text, text]


def test_names_of_classes_put_out_only_what_they_surely_mark():
    body = "This is the text of the part and it is as long as it has to be for that to be seen by the rules of it."
    for opening in ('<section id="related-work">', '<section class="reader">', '<div class="article-header">'):
        assert html_text.main_text(f"<article>{opening}<h1>A head</h1><p>{body}</p></{opening[1:].split()[0]}></article>")[0] == f"A head\n{body}"
    for opening in ('<div class="related-posts">', '<div id="reader-comments">', '<div class="newsletter signup">'):
        assert html_text.main_text(f"<article><p>{body}</p>{opening}<p>{body}</p></div></article>")[0] == body
    assert html_text.main_text(f"<article><p>\N{COPYRIGHT SIGN} {body} {body}</p><p>\N{COPYRIGHT SIGN} 2020 Someone</p><p>{body}</p></article>")[0] == f"\N{COPYRIGHT SIGN} {body} {body}\n{body}"


def test_very_long_pages_and_repeated_blocks():
    body = "This is the text of the part and it is as long as it has to be for that to be seen by the rules of it."
    text = html_text.main_text("<article>" + f"<p>{body}</p>" * 20_000 + "</article>")[0]
    assert text == "\n".join([body] * 20_000)


def test_signature_agrees_as_the_weighted_similarity():
    rng = random.Random(2)
    apart = []
    for _ in range(150):
        words = ["".join(rng.choices("abcdefgh", k=rng.randint(1, 3))) for _ in range(rng.choice([30, 200]))]
        other = list(words)
        for _ in range(rng.randint(0, 8)):
            other[rng.randrange(len(other))] = "zz"
        x, y = near_dup.shingles(" ".join(words)), near_dup.shingles(" ".join(other))
        k = rng.randint(1, 20)
        x, y = (x[0], x[1] * k), (y[0], y[1] * rng.randint(max(1, k - 2), k + 2))
        apart.append((near_dup.signature(*x) == near_dup.signature(*y)).mean() - near_dup.overlap(x, y))
    assert abs(np.mean(apart)) < 0.015 and np.std(apart) < 0.06


def test_overlap_is_that_of_multisets():
    a, b = "a b c d e f a b c d e", "a b c d e x"
    count = lambda t: collections.Counter(tuple(t.split()[i : i + 5]) for i in range(len(t.split()) - 4))
    x, y = count(a), count(b)
    want = sum((x & y).values()) / sum((x | y).values())
    assert near_dup.overlap(near_dup.shingles(a), near_dup.shingles(b)) == pytest.approx(want)
    assert near_dup.overlap(near_dup.shingles(""), near_dup.shingles(None)) == 1


@pytest.fixture(scope="module")
def vocabulary():
    return segment.Vocabulary([("", False), ("<0x0A>", True), *[(f"<0x{i:02X}>", True) for i in range(256) if i != 10], *[(p, False) for p in "▁the ▁a th he ▁t ▁ t h e a b ab ba aba".split()]])


def _all(v, text):
    """Every segmentation of a text with its probability, by plain recursion over its chunks."""
    def ways(s):
        if not s:
            return [((), 1.0)]
        out = []
        for n in range(1, len(s) + 1):
            if s[:n] in v.pieces:
                w, i = v.pieces[s[:n]]
                out += [((i, *r), w * p) for r, p in ways(s[n:])]
        if s[0] not in v.pieces:
            spelled = s[0].encode()
            out += [((*[v.byte_ids[b] for b in spelled], *r), v.byte_share ** len(spelled) * p) for r, p in ways(s[1:])]
        return out

    got = [((), 1.0)]
    for chunk in segment._CHUNK.findall(" " + text):
        part = ways(chunk)
        total = sum(p for _, p in part)
        got = [((*a, *b), p * q / total) for (a, p), (b, q) in itertools.product(got, part)]
    return dict(got)


def test_samples_are_distinct_exact_and_weighed(vocabulary):
    text = "the aba"
    exact, lattices = _all(vocabulary, text), segment.Lattices(vocabulary)
    assert sum(exact.values()) == pytest.approx(1)
    first, sums, n = collections.Counter(), collections.defaultdict(float), 4000
    for key in range(n):
        got = segment.sample(lattices, text, key, 3)
        assert len({tuple(ids) for ids, _, _ in got}) == len(got) == 3
        for ids, log_p, included in got:
            assert math.exp(log_p) == pytest.approx(exact[tuple(ids.tolist())])
            sums[tuple(ids.tolist())] += exact[tuple(ids.tolist())] / included
        first[tuple(got[0][0].tolist())] += 1
    for ids, p in exact.items():
        assert first[ids] / n == pytest.approx(p, abs=0.04)
    # Weighed by their inclusion, the samples of a run stand for all the probability there is.
    assert sum(sums.values()) / n == pytest.approx(1, abs=0.05)
    every = segment.sample(lattices, text, 1, 10_000)
    assert {tuple(i.tolist()) for i, _, _ in every} == set(exact) and all(x == 1 for _, _, x in every)


@pytest.mark.parametrize("text", ["", " ", "a\n\nb  the ", "日本\U0001f600 a▁b\t", "x" * 300, "the " * 50])
def test_decoding_restores_every_text(vocabulary, text):
    got = segment.sample(segment.Lattices(vocabulary), text, 3, 2)
    assert got and all(vocabulary.decode(ids.tolist()) == text for ids, _, _ in got)
    again = segment.sample_batch(segment.Lattices(vocabulary), ["the a", text], [9, 3], 2)[1]
    assert [x[0].tolist() for x in got] == [x[0].tolist() for x in again]


def test_lattices_that_pass_give_the_same_samples(vocabulary, monkeypatch):
    texts = ["the ab", "aba the", "a b ab the", "the ab"]
    want = [segment.sample(segment.Lattices(vocabulary), t, 5, 2) for t in texts]
    monkeypatch.setattr(segment, "_MOST_EDGES", 10)
    lattices = segment.Lattices(vocabulary)
    got = [segment.sample(lattices, t, 5, 2) for t in texts]
    assert [[x[0].tolist() for x in a] for a in got] == [[x[0].tolist() for x in a] for a in want]


def test_samples_are_the_same_to_the_last_bit_in_any_batch(vocabulary):
    rng = random.Random(13)
    texts = ["".join(rng.choices("theab \né日", k=rng.randint(0, 200))) for _ in range(60)]
    keys = list(range(60))
    want = segment.sample_batch(segment.Lattices(vocabulary), texts, keys)
    lattices = segment.Lattices(vocabulary)
    one = [segment.sample(lattices, t, k) for t, k in zip(texts, keys, strict=True)]
    back = [x for at in range(0, 60, 7) for x in segment.sample_batch(lattices, texts[::-1][at : at + 7], keys[::-1][at : at + 7])][::-1]
    plain = lambda all_: [[(ids.tolist(), p, q) for ids, p, q in x] for x in all_]
    assert plain(want) == plain(one) == plain(back)


def test_stretches_found_in_arrays_are_those_of_the_pattern(vocabulary, monkeypatch):
    rng = random.Random(8)
    texts = ["", " ", "\n", "a ", " b", "  ", "é\n\n 日"] + ["".join(rng.choices("ab \n\té日\U0001f600", k=rng.randint(0, 40))) for _ in range(200)]
    want = [segment._CHUNK.findall(" " + t) if t else [] for t in texts]
    sizes, symbols, starts = segment.chunks_of(texts)
    all_ = "".join(map(chr, symbols))
    assert sizes.tolist() == [len(x) for x in want]
    assert [all_[a:b] for a, b in zip(starts, [*starts[1:], len(all_)])] == [c for x in want for c in x]
    nodes = segment.Lattices(vocabulary).open(symbols, starts)
    assert len(set(nodes.tolist())) == len({c for x in want for c in x})  # equal stretches share a node, others don't
    monkeypatch.setattr(segment, "_SYMBOLS", 5)
    monkeypatch.setattr(segment, "_MOST_EDGES", 10)
    lattices = segment.Lattices(vocabulary)
    for _ in range(3):
        found = lattices.open(symbols, starts)
        assert len({*zip(found.tolist(), nodes.tolist())}) == len(set(nodes.tolist())) == len(set(found.tolist()))


def test_pieces_of_many_segmentations_are_spelled_and_compared_at_once(vocabulary):
    texts = ["the é", "", "日本\U0001f600\n", "ab"]
    ids, ends, rows = segment.sample_flat(segment.Lattices(vocabulary), texts, [1, 2, 3, 4], 2)
    parts = [ids[a:b].tolist() for a, b in zip([0, *ends[:-1]], ends)]
    own = [texts[i] for i, _, _ in rows]
    assert [vocabulary.decode(x) for x in parts] == own and set(own) == set(texts)
    assert vocabulary.spells(ids, ends, own) == [True] * len(own)
    assert vocabulary.spells(ids, ends, [t + "x" for t in own]) == [False] * len(own)
    assert vocabulary.spells(ids[:0], ends[:1] * 0, [""]) == [True]


def test_multikey_order_sorts_bytes():
    rng = random.Random(4)
    rows = [bytes(rng.choice(b"ab") for _ in range(24)) for _ in range(300)] + [b"a" * 24] * 20
    group = np.array([rng.randrange(3) for _ in rows], np.uint64)
    tie = np.array(rng.sample(range(1000), len(rows)))
    words = np.array([[int.from_bytes(r[i : i + 8]) for i in (0, 8, 16)] for r in rows], np.uint64)
    order, same = suffixes.multikey_order(group, lambda i, r: words[r, i], 3, (tie,))
    want = sorted(range(len(rows)), key=lambda i: (group[i], rows[i], tie[i]))
    assert order.tolist() == want
    assert same.tolist() == [k > 0 and (group[want[k]], rows[want[k]]) == (group[want[k - 1]], rows[want[k - 1]]) for k in range(len(want))]


def test_block_max_index_finds_the_exact_nearest():
    rng = np.random.default_rng(5)

    def vector():
        ids = np.sort(rng.choice(40, rng.integers(1, 6), replace=False))
        w = rng.random(len(ids)) + 0.1
        return ids, w / np.sqrt((w * w).sum())

    examples = [vector() for _ in range(700)]
    examples += examples[:50]
    index = toxicity.BlockMaxIndex(examples, [0] * len(examples), list(range(len(examples))), 40)
    dense = np.zeros((len(examples), 40))
    for i, (ids, w) in enumerate(examples):
        dense[i, ids] = w
    for _ in range(60):
        ids, w = vector()
        places, cosines = index.nearest(ids, w, 10)
        all_ = np.round(dense[:, ids] @ w, 9)
        want = sorted(np.flatnonzero(all_ > 0), key=lambda i: (-all_[i], i))[:10]
        assert index.names[places].tolist() == [int(i) for i in want]
        assert cosines == pytest.approx(all_[want])


def test_names_are_found_by_their_first_bits():
    rng = np.random.default_rng(3)
    for n in (0, 1, 2, 1000):
        known = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64) >> np.uint64(rng.integers(0, 40)))  # spread out, or all in one place
        asked = np.concatenate([known[::-1], known + np.uint64(1), np.array([0, (1 << 64) - 1], np.uint64)])
        place = {x: i for i, x in enumerate(known.tolist())}
        assert toxicity._Places(known).find(asked).tolist() == [place.get(x, -1) for x in asked.tolist()]


def test_words_of_texts_are_counted_as_one_by_one():
    texts = ["", None, "a b a", "1 2", "b A é日 b-b", "a"]
    words = toxicity.Words(texts)
    want = [collections.Counter(re.findall(r"[^\W\d_]+", (t or "").lower())) for t in texts]
    assert words.sizes.tolist() == [len(x) for x in want]
    own = [dict(zip(words.names[words.texts == i].tolist(), words.counts[words.texts == i].tolist())) for i in range(len(texts))]
    assert [sorted(x.values()) for x in own] == [sorted(x.values()) for x in want]
    a, = own[5]
    assert [x.get(a, 0) for x in own] == [x["a"] for x in want] and all(list(x) == sorted(x) for x in own)
    assert len(toxicity.Words([]).names) == len(toxicity.Words(["", "1"]).names) == 0


def test_postings_keep_place_and_weight_in_one_number():
    rng = np.random.default_rng(5)
    examples = [np.unique(rng.integers(0, 3000, 12)) for _ in range(700)] + [np.array([0])] * 300
    vectors = [(x, np.full(len(x), len(x) ** -0.5)) for x in examples]
    index = toxicity.BlockMaxIndex(vectors, [0] * 1000, range(1000), 3000)
    order = np.argsort(index.names)
    ids, weights = np.array([0, 5, 700, 2999]), np.array([0.5, 0.7, 0.4, 0.3])
    rare = index.column[ids] < 0
    want = [sum(w * x[1][x[0] == i].sum() for i, w in zip(ids[rare], weights[rare])) for x in vectors]
    assert 0 < rare.sum() < 4 and index.postings.nbytes == 8 * index.starts[-1]
    assert np.abs(index._met(ids, weights)[order] - want).max() < toxicity.MARGIN / 100


def test_workers_give_back_what_was_made_for_their_tasks(monkeypatch):
    words = toxicity.Vocabulary(np.empty(0, np.uint64), toxicity.Words(["a b"]).names, np.array([1, 1]), 2)
    rows = pa.RecordBatch.from_arrays([pa.array([1]), pa.array([0]), pa.array(["a b a"])], ["doc_id", "label", "text"])
    freed = []
    monkeypatch.setattr(toxicity, "release", lambda: freed.append(words._found is None))
    out = list(toxicity._example_vectors(words)(iter([rows])))
    assert sorted(out[0].column(4).to_pylist()[0]) == [1, 2] and freed == [True]
