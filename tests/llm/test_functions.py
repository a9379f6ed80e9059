"""The operators' functions against brute force, without Spark."""

from __future__ import annotations

import itertools
import re
import sys
from collections import Counter

import numpy as np
import pytest

from contrail.llm import embedding_dedup as lattice
from contrail.llm import near_dedup, packing, pii, quality_classifier, recurrent, toxicity
from contrail.llm.html_text import visible_text
from contrail.llm.quality_rules import measure

RNG = np.random.default_rng(3)


def some_text(n: int, vocabulary: int = 40) -> str:
    return " ".join(f"w{k}" for k in RNG.integers(0, vocabulary, n))


def test_state_is_carried_and_lanes_do_not_matter():
    counts = np.array([9, 7, 5, 4, 3, 2, 2, 1, 6, 6])
    shape = recurrent.Shape(recurrent.class_starts(counts[:8], 3), 2, hidden=6)
    flat = recurrent.first_weights(shape, counts, 1)
    docs = [RNG.integers(0, 10, n).astype(np.int32) for n in (70, 1, 33, 5, 64)]
    one = recurrent.score(flat, shape, docs, lanes=1, window=7)
    many = recurrent.score(flat, shape, docs, lanes=4, window=32)
    assert np.allclose(one, many, rtol=1e-5)
    assert np.allclose(recurrent.score(flat, shape, docs[2:3]), one[2], rtol=1e-5)
    assert len(recurrent.score(flat, shape, [])) == 0


def test_probabilities_of_next_ids_sum_to_one():
    counts = np.array([9, 7, 5, 4, 3, 2, 2, 1, 6, 6])
    shape = recurrent.Shape(recurrent.class_starts(counts[:8], 3), 2, hidden=6)
    flat = recurrent.first_weights(shape, counts, 1)
    docs = [np.array([3, 1, k], np.int32) for k in range(10)]
    whole = np.exp(recurrent.score(flat, shape, docs))
    start = np.exp(recurrent.score(flat, shape, [np.array([3, 1], np.int32)]))[0]
    assert whole.sum() == pytest.approx(start, rel=1e-4)


def test_learning_raises_the_likelihood():
    counts = np.full(10, 50)
    shape = recurrent.Shape(recurrent.class_starts(counts[:8], 3), 2, hidden=8)
    flat = recurrent.first_weights(shape, counts, 1)
    memory = np.full_like(flat, 1e-6)
    docs = [np.tile([0, 3, 5, 9], 100).astype(np.int32) for _ in range(20)]
    before = recurrent.score(flat, shape, docs).sum()
    for _ in range(10):
        recurrent.learn(flat, shape, docs, memory, 0.1, lanes=8)
    assert recurrent.score(flat, shape, docs).sum() > 0.5 * before
    recurrent.learn(flat, shape, docs, memory, 0.1, stride=3, excerpt=16)
    recurrent.learn(flat, shape, [], memory, 0.1)
    recurrent.learn(flat, shape, [np.array([1], np.int32)], memory, 0.1)
    assert np.isfinite(flat).all()


def brute_quality(text: str) -> tuple:
    found = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(tuple(found[i : i + 8]) for i in range(len(found) - 7))
    inside = {
        i + k
        for i in range(len(found) - 7)
        if windows[tuple(found[i : i + 8])] > 1
        for k in range(8)
    }
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (
        len(found),
        sum(map(len, found)),
        len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)),
        len(inside),
    )


@pytest.mark.parametrize("n", [0, 1, 7, 8, 9, 60, 500, 30_000])
def test_quality_measures(n):
    base = some_text(n, 5000)
    for text in (base, f"{base}\n{base}\n \n{base[:50]} ##", "é " * n):
        assert measure(text)[:5] == brute_quality(text)


def test_quality_verdicts():
    assert measure(None)[5] and not measure("")[-1]
    assert measure(some_text(200, 100_000))[-1]
    assert not measure("again " * 100)[-1]
    assert not measure(" ".join([some_text(30, 10**6)] * 4))[-1]


def test_every_training_token_gets_a_gradient():
    """Short documents of one id each: an id that no step learns from keeps its memory."""
    from contrail.llm.lm_scoring import Settings

    counts = np.ones(42)
    shape = recurrent.Shape(recurrent.class_starts(counts[:40], 3), 2, hidden=6)
    flat = recurrent.first_weights(shape, counts, 1)
    memory = np.full_like(flat, 1e-6)
    docs = [np.full(30, k, np.int32) for k in range(42)]
    recurrent.learn(flat, shape, docs, memory, 0.05, Settings().stride)
    assert (shape.split(memory)[0] > 1e-6).any(1).all()


def test_a_window_takes_few_calls():
    """What a window of learning or scoring costs besides its matrix products: calls of methods."""
    rng = np.random.default_rng(3)
    counts = np.arange(640, 0, -1.0)
    shape = recurrent.Shape(recurrent.class_starts(counts[:600], 32), 40, hidden=6)
    flat = recurrent.first_weights(shape, counts, 1)
    docs = [rng.integers(0, 640, 512).astype(np.int32) for _ in range(256)]
    calls = Counter()

    def count(frame, event, what):
        calls[event] += 1

    for windows, run in (
        (64, lambda: recurrent.learn(flat.copy(), shape, docs, np.full_like(flat, 1e-6), 0.05)),
        (32, lambda: recurrent.score(flat, shape, docs)),
    ):
        calls.clear()
        sys.setprofile(count)
        try:
            run()
        finally:
            sys.setprofile(None)
        assert calls["c_call"] + calls["call"] < 400 * windows


def test_a_step_follows_the_gradient():
    """With a great memory a step is the gradient times a constant; it is held to differences."""
    rng = np.random.default_rng(4)
    counts = np.arange(12, 0, -1.0)
    shape = recurrent.Shape(recurrent.class_starts(counts[:10], 3), 2, hidden=4)
    flat = recurrent.first_weights(shape, counts, 1)
    docs = [rng.integers(0, 12, n).astype(np.int32) for n in (7, 4, 5)]
    own = flat.copy()
    recurrent.learn(own, shape, docs, np.full_like(flat, 1e4), 100.0, lanes=1, window=16)
    step, wide = flat - own, flat.astype(np.float64)
    for k in rng.choice(len(flat), 60, replace=False):
        up, down = wide.copy(), wide.copy()
        up[k], down[k] = wide[k] + 1e-3, wide[k] - 1e-3
        both = [recurrent.score(w.astype(np.float32), shape, docs).sum() / 16 for w in (up, down)]
        assert abs(step[k] - (both[1] - both[0]) / 2e-3) < 2e-3


def test_pieces_hold_the_words_of_all_rows():
    import pyarrow as pa

    from contrail.llm.common import words
    from contrail.llm.lm_scoring import Corpus, lookup, pieces, tail_class

    texts = [" A b\t\vB\f", None, "", "\r\n ", "É\u2028é\x1cx \u00a0 A", "b " * 9, "Ünseen x"]
    batches = [pa.record_batch([pa.array(texts[a : a + 2], pa.string())], ["text"]) for a in range(0, 8, 2)]
    known = pa.array(["b", "", "a"])
    corpus = Corpus(known, 1, np.array([0, 1, 2]), np.ones(3), 9, 3, np.ones((5, 2)), np.ones(8), (0, 3))
    for tokens in (1, 8, 1000):
        found = list(pieces(iter(batches), tokens))
        assert [w.encode() for p in found for w in p.words.to_pylist()] == [w for t in texts for w in words(t)]
        assert [n for p in found for n in p.counts] == [len(words(t)) for t in texts]
        rows = [ids.tolist() for p in found for ids in lookup(p, corpus, 3).by_row()]
        ids = {b"b": 0, b"": 1, b"a": 2}
        assert rows == [[ids.get(w, 3 + tail_class(w, 5)) for w in [*words(t), b""]] for t in texts]
    assert len(list(pieces(iter(batches), 1))) == 4 and not list(pieces(iter([]), 1))


def test_shingles_and_similarity():
    text = some_text(50, 1000)
    found = text.split()
    assert len(near_dedup.shingles(text)) == len({tuple(found[i : i + 5]) for i in range(46)})
    assert len(near_dedup.shingles("A b")) == 1
    assert (near_dedup.shingles("A b") == near_dedup.shingles(" a\tB\n")).all()
    assert (near_dedup.shingles("a b") != near_dedup.shingles("b a")).all()
    assert not len(near_dedup.shingles(None)) and not len(near_dedup.shingles(" \n"))
    a = np.arange(100, dtype=np.uint64)
    assert near_dedup.similar(a, a[:75], 75) and not near_dedup.similar(a, a[:74], 75)


def test_regions_of_any_size_stay_connected():
    settings = near_dedup.Settings()
    for labels in (
        np.zeros((400, 16), ">u2"),
        np.sort(RNG.integers(0, 3, (300, 16)).astype(">u2").view("V32"), 0).view(">u2").reshape(-1, 16),
    ):
        i, j = near_dedup.region_pairs(labels, settings)
        root = np.arange(len(labels))
        for _ in range(len(labels)):
            least = np.minimum(root[i], root[j])
            np.minimum.at(root, i, least)
            np.minimum.at(root, j, least)
        assert (root == 0).all()
        assert len(i) <= len(labels) * settings.region


def test_lattice_decoding_and_probes():
    x = RNG.normal(0, 1.5, (200, 8))
    home = lattice.nearest_e8(x)
    around = lattice.e8_neighbours()
    assert len(around) == 240 and set((around**2).sum(1)) == {8}
    whole = (home % 2 == 0).all(1) | (home % 2 == 1).all(1)
    assert whole.all() and (home.sum(1) % 4 == 0).all()
    distance = ((2 * x - home) ** 2).sum(1)
    for v in around:
        assert (((2 * x - home - v) ** 2).sum(1) >= distance - 1e-9).all()


def test_recall_at_the_threshold():
    u = RNG.normal(size=(1000, 64))
    u /= np.linalg.norm(u, axis=1)[:, None]
    w = RNG.normal(size=u.shape)
    w -= (w * u).sum(1)[:, None] * u
    w /= np.linalg.norm(w, axis=1)[:, None]
    v = 0.93 * u + np.sqrt(1 - 0.93**2) * w
    a, b = lattice.cells(u, lattice.Settings()), lattice.cells(v, lattice.Settings())
    met = ((a == b[:, :, :1]).any(2) | (b == a[:, :, :1]).any(2)).any(1)
    assert met.mean() > 0.98


def brute_spans(text: str) -> list[tuple[int, int, str]]:
    patterns = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
        "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+",
        "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    }
    out = []
    for kind, pattern in patterns.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == "ip" and max(map(int, m.group().split("."))) > 255:
                continue
            if kind == "card" and not (12 <= len(digits) <= 19 and pii.luhn(digits)):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append((m.start(), m.end(), kind))
    return sorted(out, key=lambda s: (s[0], pii.BASE_KINDS.index(s[2])))


def test_base_spans():
    alphabet = list("aB.@-+%() 0123456789é\n")
    for _ in range(3000):
        text = "".join(RNG.choice(alphabet, RNG.integers(0, 40)))
        assert pii.base_spans(text) == brute_spans(text), text
    text = "x 4111-1111 1111 1111, +1 (212) 555-0100 at 010.0.0.255 a@b.co.uk@c.d 1.2.3.4.5.6.7.8"
    assert pii.base_spans(text) == brute_spans(text)
    text = "1" * 2000 + "a" * 2000 + "@b.c"
    assert pii.base_spans(text) == brute_spans(text)
    assert pii.base_spans("1" * 100_000 + " a@b.c")[0][2] == "email"


def test_reliabilities_follow_the_votes():
    good = sum(2 * 3**k for k in range(len(pii.LABELERS)))
    bad = 0
    belief = pii.reliabilities(np.array([0, 0]), np.array([good, bad]), np.array([50, 80]), 30)
    assert belief[0] > 0.9 and belief[1] < 0.1


def test_boundaries_are_optimal():
    for _ in range(30):
        lengths = np.sort(RNG.choice(60, 8, False)) + 1
        counts = RNG.integers(1, 30, 8)
        k = int(RNG.integers(1, 5))

        def padding(ends):
            return sum(c * (min(e for e in ends if e >= n) - n) for n, c in zip(lengths, counts))

        best = min(
            padding([*cut, lengths[-1]])
            for size in range(k)
            for cut in itertools.combinations(lengths[:-1].tolist(), size)
        )
        found = packing.best_boundaries(lengths, counts, k)
        assert len(found) <= k and found[-1] == lengths[-1] and padding(found) == best
    assert packing.best_boundaries(np.array([], int), np.array([], int), 4) == []


def test_label_model_finds_accuracies():
    n, width, prior = 40_000, 6, 0.2
    toxic = RNG.random(n) < prior
    fires = np.linspace(0.3, 0.6, width)
    v = RNG.random((n, width)) < np.where(toxic[:, None], fires, 0.01)
    model = toxicity.label_model(n, v.sum(0), v.T.astype(float) @ v, prior)
    assert np.allclose(model.fires_toxic, fires, atol=0.08)
    masks = (v << np.arange(width)).sum(1)
    assert ((model.posterior(masks) > 0.5) == toxic).mean() > 0.9


def test_ordered_thresholds_and_grades():
    import pandas as pd

    grades = RNG.integers(0, 3, 600)
    texts = [" ".join([f"g{g}"] * 5 + [some_text(5)]) for g in grades]
    settings = quality_classifier.Settings(passes=100)
    found = [quality_classifier.features(t, settings.bits) for t in texts]
    rows = pd.DataFrame({"grade": grades, "ids": [f[0] for f in found], "values": [f[1] for f in found]})
    model = quality_classifier.Model(*quality_classifier.fit(rows, settings))
    assert (np.diff(model.thresholds) > 0).all()
    tails = model.tails(np.array([float(model.weights[i] @ v) for i, v in found]))
    assert (tails[:, 0] >= tails[:, 1]).all()
    assert (np.rint(tails.sum(1)) == grades).mean() > 0.95


@pytest.mark.parametrize(
    ("html", "text"),
    [
        (None, ""),
        ("", ""),
        ("a  b<!-- no -->c", "a bc"),
        ("<p>one<p>two", "one\n\ntwo"),
        ("<ul><li>a<li>b<ol start=3><li>x<li>y</ol></ul>z", "- a\n- b\n  3. x\n  4. y\n\nz"),
        ("<table><tr><th>Name<th>N<tr><td>ab cd<td>3</table>", "Name   N\nab cd  3"),
        ("<table><tr><td>a<table><tr><td>x<td>y</table><td>b</table>", "a     b\n\nx  y"),
        ("<div hidden>no</div><span style='display: none'>no</span><script>no</script>ok", "ok"),
        ("<pre>a\n  b</pre>c", "a\n  b\n\nc"),
        ("x &amp; &lt;y&gt; &eacute;", "x & <y> é"),
        ("</div></p><td>stray</b>", "stray"),
        ("<div>" * 30_000 + "deep", "deep"),
        ("<![foo[bar]]>x", "x"),
        ("<svg><text><![CDATA[a<b]]></text></svg>", "a<b"),
        ("<head><title>T<p>Hello", "Hello"),
        ("a<plaintext>b <i>c</i> &amp;", "a\n\nb <i>c</i> &amp;"),
        ("a<br><br>b<br>", "a\n\nb"),
        ("<p style='visibility:hidden'>a <b style='visibility: visible'>b</b> c", "b"),
        ("<p style='display:none'>a <b style='visibility:visible;display:block'>b</b>", ""),
        ("<dialog>a</dialog><dialog open>b</dialog>", "b"),
        ("<details><summary>S</summary>a</details><details open><summary>T</summary>b", "S\nT\nb"),
        ("<table><tr><td rowspan=2>a<td>b<tr><td>c<td>d</table>", "a  b\n   c  d"),
        ("<table><tr><td rowspan=0>a<td>b<tr><td>c<tr><td>d</table>", "a  b\n   c\n   d"),
        ("<table><tr><td colspan=12345>a<td>b<tr><td>c<td>d</table>", "a     b\nc  d"),
        ("<html><head><title>T</title><p>Hello", "Hello"),
        ("a <math><mi>x</mi><mo>=</mo><mn>2</mn><annotation>no</annotation></math> b", "a x=2 b"),
        ("<svg><title>no</title><desc>no</desc><defs/><path d=x /><text>one</text><text>two</text></svg>z", "one\ntwo\nz"),
        ("<svg><defs><text>no</text></defs><text>yes</text></svg>", "yes"),
        ("a<textarea>b  c\nd</textarea>e", "a\nb  c\nd\ne"),
        ("a<select><option>no<option selected>yes<option>no</select>b", "a yes b"),
        ("<select><option disabled>no<option>yes</select>", "yes"),
        ("<select multiple><optgroup label=g><option>a<option label=b>no</select>c", "a\nb\nc"),
        ("<select size=10><option>a<option>b</select>", "a\nb"),
        ("<head>\n<meta charset=utf-8>\n<title>T</title>\nHello <b>you</b>", "Hello you"),
        ("<head><style>no</style><noscript><p>no</noscript><template><p>no</template></head>yes", "yes"),
        ("<head><script>no</script><link rel=x><div>yes</div></head><body>too", "yes\ntoo"),
    ],
)
def test_visible_text(html, text):
    assert visible_text(html) == text


def naive_lines(pieces):
    """Nested ``(tag, children)`` and text, by recursion: lines, and None where a blank line is due."""
    out, inline = [], []

    def end():
        out.extend([" ".join(inline)] if inline else [])
        inline.clear()

    for piece in pieces:
        if isinstance(piece, str):
            inline.append(piece)
        elif piece[0] == "i":
            inline.extend(piece[1])
        elif piece[0] != "script":
            end()
            tag, children = piece
            if tag == "table":
                cells = [[" ".join(c) for c in row] for row in children]
                width = [max(len(r[k]) for r in cells) for k in range(len(cells[0]))]
                inner = ["  ".join(c.ljust(w) for c, w in zip(r, width)).rstrip() for r in cells]
            else:
                inner = naive_lines(children)
            out += [*inner] if tag == "div" else [None, *inner, None]
    end()
    return out


def naive_text(pieces):
    out, gap = [], False
    for line in naive_lines(pieces):
        if line is not None:
            out += ["", line] if gap and out else [line]
        gap = line is None
    return "\n".join(out)


def some_pieces(depth):
    out = []
    for _ in range(RNG.integers(1, 5)):
        kind = RNG.choice(["text", "i", "script", "p", "div", "table"])
        if kind == "text" or depth == 0:
            out.append(f"w{RNG.integers(0, 10**RNG.integers(1, 6))}")
        elif kind in ("i", "script", "p"):
            out.append((kind, [f"x{k}" for k in range(RNG.integers(1, 4))]))
        elif kind == "table":
            columns = RNG.integers(1, 4)
            cell = lambda: [f"c{k}" * RNG.integers(1, 4) for k in range(RNG.integers(1, 3))]
            out.append((kind, [[cell() for _ in range(columns)] for _ in range(RNG.integers(1, 4))]))
        else:
            out.append((kind, some_pieces(depth - 1)))
    return out


def as_html(pieces):
    out = []
    for piece in pieces:
        if isinstance(piece, str):
            out.append(f" {piece} ")
        elif piece[0] == "table":
            rows = ["<tr>" + "".join(f"<td>{' '.join(c)}" for c in row) for row in piece[1]]
            out.append(f"<table>{''.join(rows)}</table>")
        else:
            out.append(f"<{piece[0]}>{as_html(piece[1])}</{piece[0]}>")
    return "".join(out)


def test_visible_text_of_plain_trees_against_a_naive_renderer():
    for _ in range(400):
        pieces = some_pieces(3)
        assert visible_text(as_html(pieces)) == naive_text(pieces), as_html(pieces)


def test_no_markup_is_an_error_or_grows_without_bound():
    parts = [*"<>![]-/?=&;'\" \n", "a", "&#xD800;", "<!", "</", "<![", "<?", "]]>", "-->", "<!--", "colspan=9999", "rowspan=0"]
    tags = "p b table tr td th title head body svg text math select option textarea pre br li ol details dialog plaintext xmp script"
    parts += [f"<{t}>" for t in tags.split()] + [f"</{t}>" for t in tags.split()] + ["<td colspan=1000 rowspan=70000>"]
    for _ in range(4000):
        page = "".join(RNG.choice(parts, RNG.integers(1, 60)))
        assert len(visible_text(page)) <= 40 * len(page) + 100, page


def test_a_wide_table_is_not_padded_without_bound():
    wide = "<table><tr><td>" + "x" * 3000 + "<tr>" + "<td>" + "y" * 120 + "<tr><td>a<td>b" * 8000 + "</table>"
    spans = "<table><tr>" + f"<td>{'x' * 100}" * 900 + "<tr><td colspan=100000>b<td>y" * 8000 + "</table>"
    for page in (wide, spans):
        text = visible_text(page)
        assert text.count("\n") >= 8000 and len(text) <= 10 * len(page)
