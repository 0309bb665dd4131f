"""Main text of pages, whitening and hard negatives."""

from __future__ import annotations

import html
import math
import random
import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from settle.llm import hard_negatives, html_text, vectors, whitening
from settle.llm.common import table
from settle.llm.queries import QUERIES
from tests.llm.conftest import clashing

SMALL = "/root/testdata/sf0.001"

# --- main text ------------------------------------------------------------------------------------


def main_text(page: str) -> str:
    return "\n".join(b.text for b, is_main in html_text.main_blocks(page, html_text.trained()) if is_main)


def plain_article(page: str) -> str:
    """The article of the tables' one layout, by cutting it out."""
    article = re.search(r"<article>(.*?)</article>", page, re.S).group(1)
    parts = re.split(r"</?p>|</?h1>", re.sub(r"</?b>|<br>", "", article))
    return "\n".join(t for t in (" ".join(html.unescape(p).split()) for p in parts) if t)


def test_articles_of_the_tables(spark):
    pages = {r.page_id: r.html for r in table(spark, SMALL, "pages").collect()}
    found = QUERIES["op11_html_text"](spark, SMALL).collect()
    assert len(found) == len(pages) > 0
    for row in found:
        assert row.text == plain_article(pages[row.page_id])
        assert row.n_chars == len(row.text)


AROUND = [
    "<header><p>{}</p></header>", "<nav><ul><li><a href='/x'>{}</a></ul></nav>", "<footer>{}</footer>",
    "<aside class=sidebar><p>{}</p></aside>", "<div class='cookie-notice'>{}</div>", "<div class=ad>{}</div>",
    "<div role='alert'><p>{}</p></div>", "<form><label>{}</label><input><button>{}</button></form>",
    "<script>var t='<p>{}</p>'</script>", "<style>p {{content: '{}'}}</style>", "<!-- <p>{}</p> -->",
    "<section id='comments'><div class='comment'><p>{}</p></div></section>", "<noscript>{}</noscript>",
    "<div class='userComments'><article><p>{}</p></article></div>", "<template><p>{}</p></template>",
    "<div class='newsletter-signup'><p>{}</p></div>", "<div hidden>{}</div>", "<ul class=menu><li>{}</ul>",
    "<div style='display: none'>{}</div>", "<ins class=adsbygoogle>{}</ins>", "<dialog><p>{}</p></dialog>",
]


@pytest.mark.parametrize("times", [1, 6, 60])
def test_what_surrounds_an_article_goes_whatever_its_length(times):
    junk = "buy some more of it " * times
    inside = "<h1>One &amp; only</h1><p>first</p>{}<p>A <a href='a>b'>second</a> one</p><p>x</p>"
    for layout in AROUND:
        noise = layout.replace("{}", junk).replace("{{", "{").replace("}}", "}")
        for page in (
            f"<body>{noise}<article>{inside.format('')}</article></body>",
            f"<body><article>{inside.format('')}</article>{noise}</body>",
            f"<body><article>{inside.format(noise)}</article>",
        ):
            if "header" in layout and page.startswith("<body><article><h1>One &amp; only</h1><p>first</p><"):
                continue  # within an article a header is that of the article
            assert main_text(page) == "One & only\nfirst\nA second one\nx", page[:200]


def test_pages_without_an_element_for_the_text():
    words = "lorem ipsum dolor sit amet "
    page = (
        "<div id=menu><a href=/>home</a> <a href=/a>about</a></div><div><p>" + words * 9 + "</p><p>" + words * 12
        + "</p><p>" + words * 7 + "</p></div><div class=footer>imprint</div>"
    )
    assert [line.count(" ") + 1 for line in main_text(page).split("\n")] == [45, 60, 35]


def test_lenient_reading():
    assert main_text("plain &lt;text&gt; only") == "plain <text> only"
    assert main_text("<p>a<script>var x='</p>'</script> b <svg><path d='M'/><text>no</text></svg>c") == "a b c"
    assert main_text("<article>1 < 2<br>3<hr>4<ul><li>a<li>b</ul></article>") == "1 < 2 3\n4\na\nb"
    assert main_text("<article><p>a&nbsp;&#65;\n\t b</p><p>cut <a hre") == "a A b\ncut"
    assert main_text("<head><title>t</title><p>body <i>i</i>n<b>e</b></p>") == "body ine"
    assert main_text("<ARTICLE><P>up<P>per</ARTICLE>") == "up\nper"
    for nothing in ("", " \n ", "<", "<!-- open <p>x", "<script>never ended <p>x", "<a href='x>", "</p>", "<p></p>"):
        assert main_text(nothing) in ("", "<")


def test_odd_pages_take_time_in_proportion():
    start = time.time()
    for unit in ("<div>", "<a ", '<a "', "<a x='", "<!--", "<script>", "</span>", "<title>a</title", "<p>x"):
        html_text.blocks(unit * 40_000)
    html_text.blocks("<div>" * 40_000 + "x" + "</span>" * 40_000 + "</div>" * 40_000)
    assert len(html_text.blocks("x" * 2_000_000)) == 1
    assert time.time() - start < 30


def test_null_empty_and_repeated_pages(spark):
    rows = [(1, None, None), (2, "u", ""), (3, "u", "<article>x"), (3, "u", "<article>x"), (None, None, "<p>y z")]
    pages = clashing(spark.createDataFrame(rows, "page_id long, url string, html string"))
    pages = pages.withColumn("text", F.lit("clash")).withColumn("n_chars", F.lit("clash"))
    found = sorted(map(tuple, html_text.extract(pages).collect()), key=str)
    assert found == sorted(
        [(1, None, "", 0), (2, "u", "", 0), (3, "u", "x", 1), (3, "u", "x", 1), (None, None, "y z", 3)], key=str
    )
    assert html_text.extract(pages.limit(0)).count() == 0
    kept = html_text.block_table(pages).filter("is_main").orderBy("page_id").collect()
    assert [(r.page_id, r.text, r.words) for r in kept] == [(None, "y z", 2), (3, "x", 1), (3, "x", 1)]


def test_the_tree_fits_its_table_and_pages_it_has_not_seen():
    parsed = [html_text.blocks(page) for page in html_text.labelled_pages()]
    assert 300 < sum(map(len, parsed)) < 2000
    right = total = 0
    each = len(parsed) // 3  # lengths of a layout are left out together
    for left_out in range(each):
        rest = [f for i, f in enumerate(parsed) if i % each != left_out]
        rows = np.vstack([html_text.features(f) for f in rest])
        tree = html_text.Tree(rows, np.array([b.labelled for f in rest for b in f], float))
        found = parsed[left_out]
        right += int((tree.predict(html_text.features(found)) == [b.labelled for b in found]).sum())
        total += len(found)
    assert right / total > 0.95


# --- integer vectors --------------------------------------------------------------------------------

ODD_VECTORS = [
    (1, None, 1), (2, [], 1), (3, [0.5, None], 1), (4, [float("nan"), 1.0], 1), (5, [float("inf"), 1.0], 1),
    (6, [0.5, -0.0], None), (7, [0.501, -0.001], 2), (8, [0.501, -0.001], 2), (None, [1.0, 2.0], 2),
    (9, [100.0, -3e5], 2), (9, [100.0, -3e5], 2), (10, [1e12, 2.0], 3),
]


def vector_rows(spark, rows, kind="float"):
    frame = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>, label int")
    extra = "x row_id n rank key ask anchor score component whitened deviation".split()
    return frame.withColumns({name: F.lit("clash") for name in extra})


def test_vectors_survive_packing(spark):
    import pyarrow as pa

    own = np.random.default_rng(1)
    for limit in (1 << 10, 1 << 20, 1 << 50):
        entries = own.integers(-limit, limit, (50, 7))
        entries[::2] //= 1 << 8
        assert (vectors.unpacked(vectors.packed(entries)) == entries).all()
    at, found = vectors.integers(pa.array([v for _, v, _ in ODD_VECTORS[:9]], pa.list_(pa.float32())))
    assert at.tolist() == [5, 6, 7, 8]
    assert found.tolist() == [[128, 0], [128, -1], [128, -1], [256, 512]]
    with pytest.raises(ValueError):
        vectors.integers(pa.array([[1.0], [1.0, 2.0]]))


# --- whitening --------------------------------------------------------------------------------------


def test_spectrum_of_hard_matrices():
    own = np.random.default_rng(2)
    for size in (1, 2, 3, 17, 64):
        turn, _ = np.linalg.qr(own.standard_normal((size, size)))
        for values in (
            own.random(size), np.ones(size), np.repeat([1.0, 2.0], [size // 2, size - size // 2]),
            np.logspace(0, -14, size), np.arange(size, dtype=float), np.zeros(size), -own.random(size),
            1 + 1e-12 * np.arange(size),
        ):
            matrix = turn @ np.diag(values) @ turn.T
            matrix = (matrix + matrix.T) / 2
            found = whitening.eigenvectors(matrix)
            scale = max(1e-300, np.abs(values).max())
            assert np.abs(found.T @ found - np.eye(size)).max() < 1e-12
            inner = found.T @ matrix @ found
            assert np.abs(inner - np.diag(np.diag(inner))).max() < 1e-13 * scale * max(8, size)
            assert np.allclose(np.sort(np.diag(inner)), np.sort(values), atol=1e-13 * scale * max(8, size))


def plain_whitening(rows, most=4):
    """By the letter of the definition, with numpy's eigenvectors."""
    kept = [(i, [math.floor(256 * float(np.float32(c))) for c in v]) for i, v, _ in rows
            if v and all(c is not None and math.isfinite(c) for c in v)]
    fit = np.array(sorted({tuple(x) for _, x in kept}), float)
    n, sums = len(fit), fit.sum(axis=0)
    centred = fit - sums / n
    values, turn = np.linalg.eigh(centred.T @ centred / n)
    out = {}
    for i, x in kept:
        deviation = sum((n * int(a) - int(s)) ** 2 for a, s in zip(x, sums, strict=True))
        for k in range(1, min(most, len(values)) + 1):
            white = (np.array(x) - sums / n) @ turn[:, -k] / np.sqrt(values[-k])
            out.setdefault((i, k), []).append((n, deviation, white, values[-k] / values.sum()))
    return out


def test_whitening_by_its_definition(spark, scratch):
    own = np.random.default_rng(3)
    base = own.standard_normal((60, 6)) * [3, 2.5, 2, 1, 0.5, 0.1]
    rows = [(i, [float(c) for c in v], 1) for i, v in enumerate(base)]
    rows += [(100 + i, rows[0][1], 1) for i in range(40)]  # one vector is a third of the rows
    rows += [(1, None, 1), (2, [1.0] * 5 + [None], 1), (3, [float("nan")] * 6, 1), (7, rows[7][1], None)]
    found = whitening.whiten(vector_rows(spark, rows), scratch).collect()
    want = plain_whitening(rows)
    assert len(found) == sum(map(len, want.values())) == 101 * 4
    signs = {}
    for row in found:
        n, deviation, white, share = want[row.vec_id, row.component][0]
        assert (row.n, row.deviation) == (n, deviation)
        assert abs(row.explained - share) < 1e-12 and row.identity_error < 1e-9
        sign = signs.setdefault(row.component, 1 if row.whitened * white > 0 else -1)
        assert abs(sign * row.whitened - white) < 1e-9


def test_whitening_without_variance_and_of_odd_rows(spark, scratch):
    from settle.llm.common import Scratch

    def whitened(rows):
        return whitening.whiten(vector_rows(spark, rows, "double"), Scratch(spark)).collect()

    assert whitened([]) == []
    assert whitened([(1, None, 1), (2, [], 1)]) == []
    assert whitened([(1, [1.0, 2.0], 1), (2, [1.0, 2.0], 1)]) == []
    found = whitened([(1, [1.0, 2.0], 1), (2, [2.0, 4.0], 1), (None, [2.0, 4.0], None)])
    assert sorted((str(r.vec_id), r.component, r.n) for r in found) == [("1", 1, 2), ("2", 1, 2), ("None", 1, 2)]
    assert sorted(round(abs(r.whitened), 12) for r in found) == [1.0, 1.0, 1.0]
    assert len(whitened([row for row in ODD_VECTORS])) == 7 * 2


def test_deviations_beyond_a_long_are_null():
    entries = np.array([[1 << 40, 0], [3, 4]])
    found = whitening.deviations(1 << 20, entries, np.array([0, 0])).to_pylist()
    assert found == [None, (3 << 20) ** 2 + (4 << 20) ** 2]
    edge = np.array([[3037000499], [3037000500]])
    assert whitening.deviations(1, edge, np.array([0])).to_pylist() == [3037000499**2, None]


# --- hard negatives -----------------------------------------------------------------------------------


def plain_negatives(rows, anchors, positives=5, negatives=3, low=50, high=95):
    """By the letter of the definition; rows are (id, label, integer vector)."""
    out = []
    for anchor, label, x in rows:
        if not anchors(anchor):
            continue
        scored = [(-sum(a * b for a, b in zip(x, y, strict=True)), i, other == label)
                  for i, other, y in rows if i != anchor]
        near = sorted(s for s in scored if s[2])[:positives]
        for p, positive, _ in near:
            fits = sorted((s, i) for s, i, same in scored if not same and low * -p <= 100 * -s <= high * -p)
            out += [(anchor, positive, rank, i, -p, -s) for rank, (s, i) in enumerate(fits[:negatives], 1)]
    return sorted(out)


def test_pairs_above_a_threshold():
    own = np.random.default_rng(4)
    for size, scale in ((5, 100), (8, 100), (40, 300), (64, 1 << 27)):
        rows = own.integers(-scale, scale + 1, (300, size))
        rows[own.random(rows.shape) < 0.6] = 0
        rows[:20] = rows[0]
        queries = np.vstack([rows[:3], own.integers(-scale, scale + 1, (30, size))])
        block = hard_negatives.Block(np.arange(300), np.zeros(300, int), rows)
        scores = queries.astype(object) @ rows.T.astype(object)
        for share in (0.999, 0.95, 0.5, 0.0):
            least = np.quantile(scores.astype(float), share, axis=1).astype(np.int64)
            if scale < 1000:
                least[5] = hard_negatives.EVERY
            at, row, found = block.pairs(queries, least)
            want = {(q, r): scores[q, r] for q in range(len(queries)) for r in range(300) if scores[q, r] >= least[q]}
            assert dict(zip(zip(at.tolist(), row.tolist(), strict=True), found.tolist(), strict=True)) == want
            assert len(found) == len(want)


@pytest.mark.parametrize("spread", ["even", "groups", "copies"])
def test_negatives_by_their_definition(spark, scratch, spread):
    own = random.Random(spread)
    centres = [[own.gauss(0, 1) for _ in range(12)] for _ in range(4)]
    rows = []
    for i in range(420):
        label = own.choice([0, 0, 0, 1, 2, 3])
        v = [own.gauss(0, 1) + (centres[label][k] * 2 if spread == "groups" else 0) for k in range(12)]
        if spread == "copies" and i % 3 == 0:
            v, label = [0.5] * 12, i % 4
        rows.append((i, [float(np.float32(c)) for c in v], label))
    rows += [(900, [1.0] * 12, 9), (901, [-1.0] * 12, 9), (950, [0.0] * 12, 0)]
    plain = [(i, label, [math.floor(256 * c) for c in v]) for i, v, label in rows]
    found = hard_negatives.mine(vector_rows(spark, rows), scratch, F.col("vec_id") % 50 == 0)
    assert sorted(map(tuple, found.collect())) == plain_negatives(plain, lambda i: i % 50 == 0)


def test_negatives_of_odd_rows(spark):
    from settle.llm.common import Scratch

    def mined(rows):
        frame = vector_rows(spark, rows, "double")
        return sorted(map(tuple, hard_negatives.mine(frame, Scratch(spark), F.col("vec_id") % 50 == 0).collect()))

    assert mined([]) == []
    assert mined([(0, [1.0, 1.0], 1)]) == []
    assert mined([(0, [1.0, 1.0], 1), (1, [1.0, 1.0], 1)]) == []  # no other label
    assert mined([(0, [1.0, 0.0], 1), (1, [-1.0, 0.0], 1), (2, [-0.6, 0.0], 2)]) == []  # nothing above zero
    odd = [(1, None, 2), (2, [], 2), (3, [None, 1.0], 2), (4, [float("nan"), 1.0], 2), (None, [0.6, 0.0], 2),
           (5, [0.6, 0.0], None)]
    rows = [(0, [1.0, 0.0], 1), (0, [1.0, 0.0], 1), (7, [1.0, 0.0], 1), (8, [0.6, 0.0], 2), (8, [0.6, 0.0], 2), *odd]
    assert mined(rows) == [(0, 7, 1, 8, 65536, 39168), (0, 7, 2, 8, 65536, 39168)]
