"""Language, main text, templates and the pipeline."""

from __future__ import annotations

import math
import random
import re
import zlib
from pathlib import Path
from xml.etree import ElementTree

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from truegrain.llm import catalog, html_text, language, templates

FOLDER = "/root/testdata/sf0.001"


# --- language


def test_held_out_accuracy(spark):
    found = catalog.QUERIES["op5_hyperdimensional_language"](spark, FOLDER)
    truth = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "lang", "text")
    rows = found.join(truth, "doc_id").collect()
    assert len(rows) == truth.count()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    assert all(0 <= r["score"] <= 1 for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert sum(r["lang"] == r["lang_pred"] for r in held) >= 0.97 * len(held)


def test_bundle_is_the_sum_of_bound_letters():
    space = language.Space(64, 3)
    assert space.bundles(["\u0301 \u0301", "e\u0301"])[1].tolist() == [False, True]
    texts = ["Ab, ba", "", "12 é", "abab abab"]
    bundles, has = space.bundles(texts)
    assert has.tolist() == [True, False, True, True]

    def letter(sign):
        return 2 * np.random.default_rng([20_24, ord(sign)]).integers(0, 2, 64, dtype=np.int8).astype(int) - 1

    for text, bundle in zip(texts, bundles):
        plain = " " + " ".join(re.findall(r"[a-zé]+", text.lower())) + " "
        plain = re.sub(" +", " ", plain)
        total = np.zeros(64)
        for i in range(len(plain) - 2):
            a, b, c = (letter(s) for s in plain[i : i + 3])
            total += np.roll(a, 2) * np.roll(b, 1) * c
        assert np.allclose(bundle, total)


def test_cells_do_not_matter(monkeypatch):
    texts = ["some words here", "andere Wörter dort", "x" * 50]
    whole, _ = language.Space(64, 3).bundles(texts)
    monkeypatch.setattr(language, "CELLS", 200)
    parts, _ = language.Space(64, 3).bundles(texts)
    assert np.allclose(whole, parts)


def test_language_cases(documents, rows_of):
    texts = [None, "", "12 34 !!", "the thing that was", "das Ding das war", "the thing that was"]
    df = documents(texts).withColumn("lang", F.when(F.col("doc_id") == 4, "de").when(F.col("doc_id") == 5, F.lit(None)).otherwise("en"))
    model = language.learn(df)
    assert model.languages == ["de", "en"]
    found = rows_of(language.predict(df, model, {"doc_id": F.col("doc_id")}))
    assert [r["lang_pred"] for r in found] == ["und"] * 3 + ["en", "de", "en"]
    assert [r["score"] for r in found[:3]] == [0.0] * 3
    kept = language.identified(df, model)
    assert kept.columns == df.columns and [r["doc_id"] for r in rows_of(kept)] == [3, 4, 5]
    none = df.where("doc_id > 99")
    nothing = language.learn(none)
    assert nothing.languages == []
    assert language.predict(none, model, {"doc_id": F.col("doc_id")}).count() == 0
    assert {r["lang_pred"] for r in rows_of(language.predict(df, nothing, {"doc_id": F.col("doc_id")}))} == {"und"}


def test_without_a_language_letters_stay(documents, rows_of):
    df = documents([None, "", "12 34 !!", "the thing that was", "\u0301 1", "привет"]).withColumn("lang", F.lit(None).cast("string"))
    assert [r["doc_id"] for r in rows_of(corpus_pipeline.identify_language(df.sparkSession, df, ""))] == [3, 5]


# --- main text


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body>
<div id="header"><a href=x>Home</a></div><nav><ul><li><a href="/a">Menu</a><li><a>More</a></ul></nav>
<div class="wrap"><div class="side-bar sidebar"><p>Teaser of the side</p></div><div class="content">
<h1>The title</h1><!-- <p>no</p> --><p>First part with a lot of text,
 enough&nbsp;to be <b>dense</b> &amp; long.<script>var x = "</p>";</script><p>Second part, unclosed, with <i>marks<p>Third part
is long as well, and ends here.</div><form><p>Your mail</p></form>
<div class="comments"><p>A reader wrote this very long comment, longer than all parts of the text that is above it.</p></div>
</div><footer>Imprint</footer></body></html>"""


def test_main_text():
    assert html_text.main_text(PAGE) == (
        "The title\n\nFirst part with a lot of text, enough to be dense & long.\n\n"
        "Second part, unclosed, with marks\n\nThird part is long as well, and ends here."
    )


@pytest.mark.parametrize(
    "source,text",
    [
        (None, ""),
        ("", ""),
        ("just text", "just text"),
        ("<p>", ""),
        ("<script>x</script>", ""),
        ("<div><div>a b</div></div>", "a b"),
        ("<table><tr><td>a one<td>b two<tr><td>c three</table>", "a one\n\nb two\n\nc three"),
        ("<p>x &am", "x &am"),
        ("<article><p>short</p></article><div>" + "long " * 99 + "</div>", None),
        ("<p>a<b", "a"),
        ("<p>one<br>two<p>three", "one two\n\nthree"),
    ],
)
def test_odd_pages(source, text):
    found = html_text.main_text(source)
    assert text is None or found == text


ARTICLE = "<article><h1>Title</h1><p>The text of the article, with some words.</p></article>"
PLAIN = ARTICLE.replace("article>", "div>")


@pytest.mark.parametrize("layout", ["no-sidebar", "has-sidebar", "content-sidebar-wrap", "page-with-nav", "search-results"])
@pytest.mark.parametrize("inner", [ARTICLE, PLAIN])
def test_layouts_named_for_what_they_hold(layout, inner):
    text = "Title\n\nThe text of the article, with some words."
    page = f'<body><div class="nav">Home</div><div class="{layout}">{inner}<div class="sidebar"><p>side</p></div></div></body>'
    assert html_text.main_text(page) == text
    page = f'<div class="comments"><article id="comment-1"><p>{"reply " * 99}</p></article></div>'
    assert html_text.main_text(f'<div class="{layout}">{ARTICLE}{page}</div>') == text


def test_header_of_the_article_and_attribute_values():
    page = """<body><article><div class="article-header"><h1>Title</h1></div><section aria-label="Our hidden gems"><p>One part.</p></section>
    <p title="the hidden cost">Two parts.</p><p>It is <math><mi>x</mi></math> here.</p><p hidden>no</p><p data-hidden="1">Three.</p></article></body>"""
    assert html_text.main_text(page) == "Title\n\nOne part.\n\nTwo parts.\n\nIt is x here.\n\nThree."


def some_page(pick, depth=0):
    """A well-formed page of blocks, links and bold words."""
    def line():
        words = " ".join("w" * pick.randrange(1, 9) for _ in range(pick.randrange(1, 12)))
        return pick.choice([words, words, f'<a href="x">{words}</a>', f"{words} <b>{words}</b>", f"<b><a>{words}</a></b>"])

    if depth == 4 or pick.random() < 0.3:
        return f"<p>{line()}</p>"
    inner = "".join(pick.choice([line(), "", ""]) + some_page(pick, depth + 1) for _ in range(pick.randrange(1, 5)))
    return f"<div>{inner}</div>"


def brute_blocks(page):
    """(density, sum, text) of every block in page order, by recursion over the parsed page."""
    root = ElementTree.fromstring(page)
    size = lambda text: sum(map(len, (text or "").split()))
    lines = ("a", "b")

    def counts(node, linked=False, whole=True):
        """Characters, those in links, tags, links; of the whole subtree or of what stands right in it."""
        linked = linked or node.tag == "a"
        c, lc, t, lt = size(node.text), size(node.text) if linked else 0, 0, 0
        for child in node:
            if child.tag in lines or whole:
                more = counts(child, linked, whole)
                is_link = child.tag == "a"
                c, lc, t, lt = c + more[0], lc + more[1], t + more[2] + (is_link or child.tag not in lines), lt + more[3] + is_link
            c, lc = c + size(child.tail), lc + (size(child.tail) if linked else 0)
        return c, lc, t, lt

    body = counts(root)

    def density(c, lc, t, lt):
        if not c:
            return 0.0
        base = c / max(1, c - lc) * lc + body[1] / max(1, body[0]) * c + math.e
        return c / max(1, t) * math.log(1 + c / max(1, lc) * max(1, t) / max(1, lt), base)

    found = []
    for node in root.iter():
        if node.tag not in lines:
            children = [density(*counts(child)) for child in node if child.tag not in lines]
            found.append((density(*counts(node)), sum(children) + density(*counts(node, whole=False)), node))
    return found


def test_densities_and_sums_by_recursion():
    pick = random.Random(4)
    for _ in range(150):
        source = f"<body>{some_page(pick)}{some_page(pick)}</body>"
        page = html_text.Page(source)
        density, total = page.densities()
        nodes = [i for i, name in enumerate(page.name) if name in html_text.BLOCK]
        expected = brute_blocks(source)
        assert [density[i] for i in nodes] == pytest.approx([d for d, _, _ in expected])
        assert [total[i] for i in nodes] == pytest.approx([s for _, s, _ in expected])
        # The subtree of the greatest sum, and the threshold of its path.
        best = max(range(len(nodes)), key=lambda i: (round(expected[i][1], 9), -i))
        parents = {child: node for _, _, node in expected for child in node}
        path, node = [], expected[best][2]
        while node is not None:
            path.append(node)
            node = parents.get(node)
        threshold = min(d for d, _, n in expected if n in path)
        chosen = page.chosen()
        assert nodes[best] in chosen
        assert all(density[i] >= threshold - 1e-9 or i in chosen[:1] or any(density[j] >= threshold - 1e-9 for j in ancestors(page, i)) for i in chosen)


def ancestors(page, node):
    while node > 0:
        yield node
        node = page.parent[node]


def test_density_decides(monkeypatch):
    """Two parts that nothing names: links and short lines against prose; a changed density changes the text."""
    long = "Prose with many words that go on for a while and say something. " * 6
    menu = "".join(f'<p><a href="{i}">Go to {i}</a></p>' for i in range(30))
    page = f"<body><div>{menu}</div><div><p>{long}</p><p>{long}</p><p>And so on.</p></div></body>"
    text = html_text.main_text(page)
    assert text.startswith("Prose") and text.endswith("And so on.") and "Go to" not in text
    plain = html_text.Page.densities

    def turned(self):
        density, total = plain(self)
        return [1 / d if d else 0.0 for d in density], [1 / t if t else 0.0 for t in total]

    monkeypatch.setattr(html_text.Page, "densities", turned)
    assert html_text.main_text(page) != text


def test_article_is_whole_only_if_density_chose_most_of_it():
    long = "Prose with many words that go on for a while and say something. " * 9
    inner = f"<h1>T</h1><section><p>{long}</p><p>{long}</p></section><p>x</p>"
    whole = html_text.main_text(f"<body><article>{inner}</article></body>")
    assert whole.startswith("T\n\nProse") and whole.endswith("x")
    short = '<a href="1">one</a> <a href="2">two</a>'
    elsewhere = html_text.main_text(f"<body><article>{short}</article><div><p>{long}</p><p>{long}</p></div></body>")
    assert elsewhere.startswith("Prose") and "one" not in elsewhere


def test_deep_and_long_pages():
    assert html_text.main_text("<div>" * 20_000 + "deep") == "deep"
    long = "word " * 50_000
    assert html_text.main_text(f"<body><p>{long}</p></body>") == long.strip()


def test_all_pages_against_their_markup(spark, rows_of):
    """The supplied pages have one article each, with simple markup in it."""
    import html as entities

    found = {r["page_id"]: r for r in catalog.QUERIES["op3_composite_text_density"](spark, FOLDER).collect()}
    pages = spark.read.parquet(f"{FOLDER}/pages.parquet").collect()
    assert len(found) == len(pages)
    for page in pages:
        inner = re.search(r"<article>(.*?)(</article>|\Z)", page["html"], re.S)[1].replace("<br>", " ")
        blocks = [re.sub(r"<[^>]*(>|\Z)", "", b) for b in re.split(r"</?(?:p|h1)>", inner)]
        blocks = [" ".join(entities.unescape(b).split()) for b in blocks]
        text = "\n\n".join(b for b in blocks if b)
        row = found[page["page_id"]]
        assert (row["text"], row["n_chars"], row["url"]) == (text, len(text), page["url"])


def test_pages_with_clashing_columns(spark):
    rows = [(1, "u", "<p>a", "x", 5), (1, "u", "<p>a", "x", 5), (None, None, None, None, None)]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string, text string, n_chars int")
    found = html_text.extract(df, {"page_id": F.col("page_id"), "url": F.col("url")}).collect()
    assert sorted(r["text"] for r in found) == ["", "a", "a"]
    assert html_text.extract(df.where("false"), {"page_id": F.col("page_id")}).count() == 0


# --- templates


def brute_template(text):
    """(kind, value) of every template word, by a plain loop."""
    found, begins, last = [], True, None
    for piece in text.replace("\n", " \x00 ").split():
        if piece == "\x00":
            begins, last = True, None
            continue
        table = templates.Templates()
        entries = table._piece(piece)
        for index in entries:
            kind, word, capital, ends = table.fresh[index]
            if kind == templates.UNIT and last != templates.NUMBER:
                kind = templates.LITERAL
            if kind == templates.LITERAL and capital and not begins:
                kind = templates.NAME
            if kind == templates.NAME and last == templates.NAME:
                found[-1] = (kind, found[-1][1] + " " + word)
            else:
                found.append((kind, word))
            last, begins = kind, ends
    return found


ITEM = "A farmer sold 12 apples to Anna Smith and then 30 kg of pears to Bob, so how much did the farmer earn if each kg costs 4 dollars?"


def test_template_words():
    text = ITEM + "\nThe price is $4.50 or 20% less: Nobody pays 5km for it (really) — Éva does! one apple 3 days"
    kind, value, bounds = templates.Templates().templates([text, "", ITEM])
    plain = brute_template(text)
    assert kind[: bounds[1]].tolist() == [k for k, _ in plain]
    assert bounds[1] == bounds[2] and bounds[3] - bounds[2] == len(brute_template(ITEM))
    names = {}
    for (k, word), v in zip(plain, value.tolist()):
        assert names.setdefault((k, word), v) == v


def brute_contaminated(texts, items, window=templates.WINDOW):
    found = set()
    for d, text in enumerate(texts):
        doc = brute_template(text or "")
        for n, item in enumerate(items):
            own = brute_template(item or "")
            size = min(window, len(own))
            diagonals = {}
            for p in range(len(own) - size + 1) if size else ():
                part = own[p : p + size]
                if 2 * sum(k == templates.LITERAL for k, _ in part) < size:
                    continue
                for q in range(len(doc) - size + 1):
                    there = doc[q : q + size]
                    same = all(a[0] == b[0] and (a[0] != templates.LITERAL or a[1] == b[1]) for a, b in zip(part, there))
                    if same:
                        slots = frozenset((a[0], a[1], b[1]) for a, b in zip(part, there) if a[0] != templates.LITERAL)
                        diagonals.setdefault(q - p, []).append((p, slots))
            covered = set()
            for windows in diagonals.values():
                pairs = set().union(*(s for _, s in windows))
                consistent = len(pairs) == len({s[:2] for s in pairs})
                for p, slots in windows:
                    if consistent or not slots:
                        covered |= set(range(p, p + size))
            if covered and len(covered) >= templates.LEAST_COVER * len(own):
                found.add((d, n))
    return found


def contamination_cases():
    pick = random.Random(8)
    word = lambda: pick.choice("of the sold apples pears how much did each costs farmer then".split())
    noise = lambda n: " ".join(word() for _ in range(n))
    items = [ITEM, "short item of five words", noise(30) + " 7 days", None, "", "3 4 5 6 7 8 9 10 11", noise(25) + ". " + noise(20)]
    other = ITEM.replace("12", "99").replace("Anna Smith", "Carla").replace("Bob", "Dieter Maria").replace("30 kg", "5 tons").replace(" kg ", " tons ")
    mixed = "A farmer sold 12 apples then 12 pears then 12 plums to the man."
    items.append(mixed)
    texts = [
        noise(50) + ". " + ITEM + " " + noise(40),
        noise(9) + "\n" + other,
        "x " + mixed.replace("12", "5"),
        "x " + mixed.replace("12", "5", 1).replace("12", "6", 1),
        ITEM[: len(ITEM) // 2],
        ITEM[: len(ITEM) // 4],
        items[2], items[6].upper(), items[6][:90], "a short item of five words here", None, "", noise(400), ITEM + " " + ITEM, items[5],
    ]
    return texts, items


@pytest.mark.parametrize("sent", [4_000_000, 0])
def test_contamination_against_brute_force(spark, documents, monkeypatch, sent):
    monkeypatch.setattr(templates, "MOST_SENT", sent)
    texts, items = contamination_cases()
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id bigint, text string")
    found = templates.contaminated(documents(texts), benchmark).collect()
    assert {(r["id"], r["item"]) for r in found} == brute_contaminated(texts, items)
    changed = {(r["id"], r["item"]): r["n_changed"] for r in found}
    assert changed[0, 0] == 0 and changed[1, 0] == 5
    assert (2, 7) in changed and (3, 7) not in changed


def test_contamination_cases(spark, documents, rows_of):
    benchmark = spark.createDataFrame([(1, ITEM), (1, ITEM)], "item_id bigint, text string")
    df = documents([(1, ITEM), (1, ITEM), (1, "other text of the same id"), (None, ITEM), (5, None), (6, "clean")])
    assert [r["text"] for r in rows_of(templates.clean_documents(df, benchmark), "text")] == [None, "clean", "other text of the same id"]
    assert templates.clean_documents(df, benchmark).columns == df.columns
    assert templates.clean_documents(df, benchmark.where("false")).count() == 6
    assert templates.contaminated(df.where("false"), benchmark).count() == 0


@pytest.mark.parametrize("sent", [4_000_000, 0])
def test_copies_of_few_literal_words(spark, documents, monkeypatch, sent):
    monkeypatch.setattr(templates, "MOST_SENT", sent)
    texts, items = contamination_cases()
    items += ["What is 12 + 7 * 3 - 4?", "Im Garten von Herrn Maier stehen Bäume, Büsche, Blumen und Tische aus Holz."]
    texts += ["Then: what is 12 + 7 * 3 - 4? A sum.", "Nun. " + items[-1] + " Ende", "What is 13 + 8 * 4 - 5?"]
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id bigint, text string")
    found = {(r["id"], r["item"]): r for r in templates.contaminated(documents(texts), benchmark, forms=templates.ALL_FORMS).collect()}
    more = {(14, 5), (15, 8), (16, 9)}
    assert set(found) >= more | brute_contaminated(texts, items)
    assert not {(14, 5), (15, 8)} & brute_contaminated(texts, items)
    assert all(found[k]["n_covered"] == found[k]["n_words"] for k in more)
    assert not any(d == 17 for d, _ in found)
    kept = templates.clean_documents(documents(texts), benchmark)
    assert not {d for d, _ in found} & {r["doc_id"] for r in kept.collect()}


def test_copies_in_another_case_and_names_that_begin(spark, documents):
    tom = "Tom has 5 apples and eats 2."
    long = "Tom has 5 apples. Anna eats 3 pears. Bob buys 7 plums. Tom sells 4 of them."
    items = [ITEM, tom, long, "Die Straße nach Köln ist lang und voller Autos, Busse und Räder."]
    changed = long.replace("Tom", "Eva").replace("Anna", "Carla").replace("Bob", "Karl Maria")
    texts = [
        "x " + ITEM.lower() + " y", "x " + ITEM.upper() + " y", "x " + ITEM.title() + " y", tom.replace("Tom", "Anna"),
        "Yes. " + tom.replace("Tom", "Anna Smith").replace("5", "6") + " No.", changed, "x " + items[3].upper() + " y",
        long.replace("Tom", "Eva", 1).replace("Anna", "Eva").replace("Bob", "Eva"), "Who has 5 apples and no pears?",
    ]
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id bigint, text string")
    found = {(r["id"], r["item"]): r for r in templates.contaminated(documents(texts), benchmark, forms=templates.ALL_FORMS).collect()}
    assert {(0, 0), (1, 0), (2, 0), (3, 1), (4, 1), (5, 2), (6, 3)} <= set(found)
    assert not {(0, 0), (3, 1), (4, 1), (5, 2)} & brute_contaminated(texts, items)
    assert all(found[k]["n_covered"] == found[k]["n_words"] for k in [(0, 0), (1, 0), (2, 0), (3, 1), (4, 1), (6, 3)])
    assert found[3, 1]["n_changed"] == 1 and found[4, 1]["n_changed"] == 2
    assert not {d for d, _ in found} & {8}


# --- pipeline


def test_stages_keep_the_columns(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, FOLDER)
        assert after.columns == docs.columns, name
        assert after.count() <= docs.count()


@pytest.mark.skipif(not Path(FOLDER).exists(), reason="no supplied tables")
def test_run_is_the_stages_one_after_another(spark, tmp_path):
    found = {r["doc_id"]: r for r in corpus_pipeline.run(spark, FOLDER).collect()}
    documents = spark.read.parquet(f"{FOLDER}/documents.parquet")
    assert found and set(found) <= {r["doc_id"] for r in documents.select("doc_id").collect()}
    assert all(r["n_tokens"] == len(r["ids"]) for r in found.values())
    items = {r["text"] for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()}
    dirty = {r["doc_id"] for r in documents.collect() if any(i in (r["text"] or "") for i in items)}
    assert dirty and not dirty & set(found)
