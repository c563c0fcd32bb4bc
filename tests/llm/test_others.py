"""Embeddings, pages, personal data, components and the pipeline."""

import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tenorgrid.llm import embeddings, html_cut, line_frequency, registry, surrogates
from tenorgrid.llm.common import keep, maybe_in
from tenorgrid.llm.components import components
from tests.llm import helpers as h
from tests.oracle import compare, connect


def vectors(seed=3, n=300):
    rng = np.random.default_rng(seed)
    base = rng.standard_normal((12, 16))
    rows = [(k, int(k % 3), (base[k % 12] + rng.standard_normal(16) * (0.02 + 0.2 * (k % 5) / 5)).astype("float32").tolist()) for k in range(n)]
    rows += [(1000, 1, rows[0][2]), (1001, 0, rows[0][2]), (1002, 0, [x * 3 for x in rows[0][2]]), (1003, None, rows[0][2]),
             (1004, 0, None), (1005, 0, [0.0] * 16), (1006, 0, [math.nan] * 16), (1007, 0, [None] + rows[0][2][1:]),
             (1008, 0, [math.inf] + rows[0][2][1:]), (1009, 0, []), (1010, 0, rows[0][2][:5]), (1011, 0, rows[0][2][:5])]
    return rows


def linked(rows, cosine):
    good = {}
    for i, label, v in rows:
        if label is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v):
            x = np.array(v, dtype=np.float64)
            good[i] = (label, x / np.sqrt(x @ x))
    groups, links = h.Sets([r[0] for r in rows]), dict.fromkeys((r[0] for r in rows), 0)
    for a in good:
        for b in good:
            if a < b and good[a][0] == good[b][0] and len(good[a][1]) == len(good[b][1]) and good[a][1] @ good[b][1] >= cosine:
                groups.join(a, b)
                links[a] += 1
                links[b] += 1
    return sorted((i, links[i], groups.find(i), groups.find(i) == i) for i in links)


@pytest.mark.parametrize("chunk", [1024, 3])
def test_near_vectors(spark, monkeypatch, chunk):
    monkeypatch.setattr(embeddings, "CHUNK", chunk)
    for kind, cosine in (("float", 0.98), ("double", 0.9)):
        rows = vectors()
        df = spark.createDataFrame([(*r, 0, 1) for r in rows], f"vec_id bigint, label int, embedding array<{kind}>, id int, copies int")
        got = sorted(map(tuple, embeddings.near_vectors(df, cosine=cosine).collect()))
        assert got == linked(rows, cosine)
    assert embeddings.near_vectors(df.limit(0)).count() == 0


def test_components(spark):
    chain = [(k, k + 1) for k in range(0, 40)] + [(100, 90), (90, 95), (7, 7), (200, 300)]
    groups = h.Sets({x for e in chain for x in e})
    for a, b in chain:
        groups.join(a, b)
    df = spark.createDataFrame([*chain, (None, 3)], "a bigint, b bigint")
    got = dict(map(tuple, components(df).collect()))
    assert got == {x: groups.find(x) for x in groups.parent}
    star = spark.range(1, 2000).select(F.lit(5000).cast("long").alias("a"), F.col("id").alias("b"))
    assert components(star).where("root != 1").count() == 0
    assert components(df.limit(0)).count() == 0


def test_bitmap_filter_keeps_all_ids(spark):
    ids = spark.range(0, 5000, 7)
    kept = maybe_in(spark.range(0, 20000).withColumnRenamed("id", "x"), F.col("x"), ids, "id")
    assert kept.join(ids, F.col("x") == F.col("id")).count() == ids.count() and kept.count() < 800


PAGE = """<!doctype html><html><head><title>T</title><style>p{}</style></head><body class="sidebar-left"><header><a href=/>Home</a> Site</header>
<nav><ul><li><a href=1>One</a><li><a href=2>Two</a></ul></nav><div id="cookieNotice">We use cookies on this site, please accept them all.</div>
<article><header><h1>The &lt;title&gt;</h1></header><p>First&nbsp;para <b>bold</b> goes<br>on, and on.<p>Short.<blockquote>A quote.</blockquote>
<div class="ad-box"><p>Buy this thing now, it is really cheap today only.</p></div><script>var a = "</p><p>x";</script><p>Last one &copy</p>
<section class="comments"><h2>Comments</h2><p>I liked this text very much, thank you for it!</p></section></article>
<aside><p>Something else that you may want to read one day.</p></aside><form><p>Your name, your address and all that.</p></form>
<footer>&copy; 2024 Site. All rights reserved.</footer></body></html>"""


def test_main_text():
    assert html_cut.main_text(PAGE) == "The <title>\n\nFirst para bold goes on, and on.\n\nShort.\n\nA quote.\n\nLast one ©"
    assert [html_cut.main_text(x) for x in (None, "", " ", "<nav>a</nav>", "<!-- x", "<script>")] == [""] * 6


def test_cut_is_minimal():
    """The labelling costs no more than any other, on all small graphs of a few random kinds."""
    import itertools
    import random

    random.seed(2)
    for _ in range(200):
        n = random.randint(1, 7)
        score = [random.choice([-3, -1, -0.5, 0, 0.5, 1, 2.5]) for _ in range(n)]
        edges = [(a, b, random.choice([0.2, 0.7, 1.5])) for a in range(n) for b in range(a) if random.random() < 0.5]

        def cost(side):
            return (sum(max(0, -s) if x else max(0, s) for s, x in zip(score, side))
                    + sum(w for a, b, w in edges if side[a] != side[b]))

        best = min(cost(side) for side in itertools.product((False, True), repeat=n))
        assert cost(html_cut.content_side(score, edges)) == pytest.approx(best)


def test_pages(spark):
    df = spark.createDataFrame([(1, "u", PAGE, "x"), (2, None, None, None), (2, None, None, None), (3, "v", "<p>" * 3000 + "deep text here.", None)],
                               "page_id bigint, url string, html string, text string")
    got = {r["page_id"]: r for r in html_cut.extract_text(df).collect()}
    assert got[1]["text"] == html_cut.main_text(PAGE) and got[1]["n_chars"] == len(got[1]["text"]) and got[2]["text"] == "" and got[2]["n_chars"] == 0
    assert got[3]["text"] == "deep text here."
    assert html_cut.extract_text(df).count() == 4 and html_cut.extract_text(df.limit(0)).count() == 0


def test_articles_of_the_pages(spark):
    pages = spark.read.parquet(f"{h.FOLDER}/pages.parquet")
    import html

    for r in pages.collect():
        article = re.search(r"<article>(.*?)</article>", r["html"], re.DOTALL)[1]
        blocks = [" ".join(html.unescape(re.sub("<[^>]*>", " ", re.sub("</?b>", "", x))).split()) for x in re.split("</?(?:p|h1)>", article)]
        assert html_cut.main_text(r["html"]) == "\n\n".join(b for b in blocks if b)


PERSONAL = ("Mr. John Smith met Mrs Anna Smith. Smith called +1 (564) 555-4526 or +1 564 555 4526; card 4111 1111 1111 1111, "
            "4111111111111111 DE89 3704 0044 0532 0130 ssn 123-45-6789, Господин Иванов, A@B.COM 10.20.30.40")


def test_surrogates(spark):
    rows = [(1, PERSONAL, None), (2, None, None), (3, "plain words v1.2.3.4.5 24be64439e3e49cf46b2d7c90f3602a3d0b907ff", None), (4, PERSONAL + " x@b.com", None)]
    df = h.table(spark, rows).drop("n_chars")
    got = {r["doc_id"]: r for r in surrogates.replace_entities(df).collect()}
    assert got[2]["text"] is None and got[3]["text"] == rows[2][1] and got[3]["n_entities"] == 0
    old, new = surrogates.find(PERSONAL), surrogates.find(got[1]["text"])
    assert [k for _, _, k, _ in old] == [k for _, _, k, _ in new] and got[1]["n_entities"] == len(old)
    to = {}
    for a, b in zip(old, new):
        assert to.setdefault((a[2], a[3]), b[3]) == b[3] != a[3]
    assert len(set((k, v) for (k, _), v in to.items())) == len(to)
    card = to["card", "4111111111111111"]
    assert surrogates._luhn(card) and card[0] == "4"
    assert got[4]["text"].startswith(got[1]["text"])
    assert surrogates.replace_entities(df.limit(0)).count() == 0


NAMES = {
    "Mr McDonald": ["McDonald"], "Mr O'Brien": ["O'Brien"], "Mr O’Brien's": ["O’Brien"], "Mrs Jean-Paul Sartre": ["Jean-Paul", "Sartre"],
    "Mr Dvořák": ["Dvořák"], "Mr Dvor\u030ca\u0301k": ["Dvor\u030ca\u0301k"], "Mrs Anna Maria Schmidt": ["Anna", "Maria", "Schmidt"],
    "Mr John F. Kennedy": ["John", "F. Kennedy"], "Dr J.R.R. Tolkien": ["J.R.R. Tolkien"], "Mr Łukasz Nowak": ["Łukasz", "Nowak"],
    "Mr JOHN SMITH": ["JOHN", "SMITH"], "Mrs Eva van der Berg": ["Eva", "Berg"], "Dr von Braun": ["Braun"], "Mr Παπαδόπουλος": ["Παπαδόπουλος"],
    "Госпожа Анна Мария Иванова-Петрова": ["Анна", "Мария", "Иванова-Петрова"], "Mr Smith Mrs Jones": ["Smith", "Jones"], "Dr 王小明": ["王小明"]}


def test_names_are_found_as_whole_words(spark):
    for text, expected in NAMES.items():
        for around in ("{}", "with {}, and", "a {}. He", "({})"):
            whole = around.format(text)
            assert [whole[a:b] for a, b, _, _ in surrogates.find(whole)] == expected, whole
    docs = h.table(spark, [(k, f"with {t}, and", None) for k, t in enumerate(NAMES)])
    for r in surrogates.replace_entities(docs).collect():
        old = list(NAMES)[r["doc_id"]]
        assert not any(w.split()[-1].casefold() in r["text"].casefold() for w in NAMES[old]), (old, r["text"])
        again = [r["text"][a:b] for a, b, _, _ in surrogates.find(r["text"])]
        assert r["n_entities"] == len(NAMES[old]) == len(again)
        assert [w.isupper() for w in again] == [w.isupper() for w in NAMES[old]]
        assert [surrogates._script(w) for w in again] == [surrogates._script(w) for w in NAMES[old]]


def test_one_entity_has_one_replacement(spark):
    texts = ["x Mr John Smith y", "x Dr John SMITH y", "x Mrs Maria Smith y", "x Prof Maria Smith y", "x Dr Robin Miller y", "x Mr Andrea Miller y",
             "x Mrs Andrea Miller y", "+1 415 555 1234", "(415) 555-1234", "415.555.1234", "+1 (415) 555-1234", "+41 5555 1234", "+415 555 1234"]
    got = {r["doc_id"]: r["text"] for r in surrogates.replace_entities(h.table(spark, [(k, t, None) for k, t in enumerate(texts)])).collect()}
    names = {k: got[k].split()[2:4] for k in range(7)}
    assert names[0][0] == names[1][0] and names[0][1].upper() == names[1][1] and names[2] == names[3] and names[5] == names[6]
    assert len({names[k][0] for k in (0, 2, 4, 5)}) == 4 and len({names[k][1] for k in (0, 4)}) == 2
    assert names[0][0].split("-")[0] in surrogates.FIRST["latin", "m"] and names[2][0].split("-")[0] in surrogates.FIRST["latin", "f"]
    assert names[5][0].split("-")[0] in surrogates.FIRST["latin", "n"]
    digits = {k: re.sub(r"\D", "", got[k]) for k in range(7, 13)}
    assert digits[7] == digits[10] == "1" + digits[8] == "1" + digits[9] != "14155551234" and digits[7][0] == "1"
    assert digits[11] == digits[12] != digits[8]  # one number of another country, with the digits of a national one
    for k in range(7, 13):
        assert re.sub(r"\d", "0", got[k]) == re.sub(r"\d", "0", texts[k])


def test_entities_beside_other_text():
    text = "éjohn.doe@mail.com,.4111111111111111 +1 (564) 555-4526 12 x ###152.143.123.131### 3.14 2024-01-02 v1.2.3.4.5 4785380592391139$$$"
    assert [(text[a:b], k) for a, b, k, _ in surrogates.find(text)] == [
        ("john.doe@mail.com", "email"), ("4111111111111111", "card"), ("+1 (564) 555-4526", "phone"), ("152.143.123.131", "ip"), ("4785380592391139", "card")]


@pytest.mark.parametrize("text, expected", [
    ("at 2001:db8::1 and ::1 or 2001:0db8:0000:0000:0000:0000:0000:0001", [("2001:db8::1", "ip6"), ("::1", "ip6"), ("2001:0db8:0000:0000:0000:0000:0000:0001", "ip6")]),
    ("std::vector ab::cd a:b 12:30:45", []), ("call 030 1234567 now", [("030 1234567", "phone")]), ("Tel. 5551234, phone: 555-1234", [("5551234", "phone"), ("555-1234", "phone")]),
    ("total 5551234 in 2020 10000 rows", []), ("write user@bücher.de", [("user@bücher.de", "email")]),
    ("My name is John Smith and je m'appelle Anna", [("John", "first_n"), ("Smith", "last"), ("Anna", "last")])])
def test_further_entities_are_found(text, expected):
    assert [(text[a:b], k) for a, b, k, _ in surrogates.find(text)] == expected


def test_formats_never_run_out(spark):
    """More addresses of one letter and one letter than there are, and more first names than the lists give."""
    rows = [("email", f"{a}@{b}.{e}") for a in "abcdefghijklmnopqrstuvwxyz" for b in "abcdefghijklmnopqrstuvwxyz" for e in ("com", "org", "net", "de")]
    rows += [("first_n", f"name{k}") for k in range(20_000)] + [("phone", f"55512{k:02d}") for k in range(100)] + [("ip6", f"0000:0000:0000:0000:0000:0000:0000:000{k:x}") for k in range(1, 16)]
    got = surrogates.draw_surrogates(spark.createDataFrame(rows, "kind string, value string")).collect()
    assert len({(r.kind, r.value) for r in got}) == len(rows) == len({(r.kind, r.new) for r in got}) == len(got)
    assert not {(r.kind, r.new) for r in got} & set(rows)
    assert surrogates.LABEL.fullmatch(surrogates.surrogate(b"k", "ssn", "123456789", surrogates.LAST))
    assert surrogates.written("123-45-6789", "ssn", "ssn-" + "0f" * 16) == "ssn-" + "0f" * 16


def test_replacement_equals_brute_force(spark):
    """The whole corpus replaced one text after the other from one dictionary of entities."""
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{h.FOLDER}/documents.parquet").collect()]
    got = {r.doc_id: r for r in surrogates.op5_pii_surrogates(spark, h.FOLDER).collect()}
    to, back = {}, {}
    for d, text in docs:
        found, at, new, place = surrogates.find(text or ""), 0, got[d].text, 0
        assert got[d].n_entities == len(found)
        for start, end, kind, value in found:
            gap = text[at:start]
            assert new[place: place + len(gap)] == gap
            place += len(gap)
            family = "first" if kind.startswith("first_") else kind
            rest = [b for a, b, k, v in surrogates.find(new) if a == place]
            assert rest, (text[start:end], new[place: place + 40])
            canonical = next(v for a, b, k, v in surrogates.find(new) if a == place)
            assert to.setdefault((family, value), canonical) == canonical and back.setdefault((family, canonical), value) == value
            place, at = rest[0], end
        assert new is None and text is None or new[place:] == text[at:]
    assert to and not {v for v in to.values()} & {v for _, v in to}


def test_columns_of_the_caller_stay(spark):
    names = ["_rid", "rid", "n", "_n", "_p", "_w", "_maybe", "clean", "whole", "_clean", "n_entities", "c0", "kind", "value"]
    docs = h.table(spark, [(k, f"{PERSONAL} {k}", None) for k in range(4)] + [(9, None, None)]).select("doc_id", "text")
    plain = {r.doc_id: (r.text, r.n_entities) for r in surrogates.replace_entities(docs).collect()}
    got = surrogates.replace_entities(docs.select("*", *(F.concat(F.lit(n), F.col("doc_id")).alias(n) for n in names)))
    assert got.columns == ["doc_id", "text", *names, "_n_entities"]
    for r in got.collect():
        assert (r.text, r._n_entities) == plain[r.doc_id] and all(r[n] == f"{n}{r.doc_id}" for n in names)


def test_surrogates_draw_again_on_collisions(spark):
    """A space of 81 addresses with 60 entities: all replacements differ, and none is an entity."""
    entities = spark.createDataFrame([("ip", f"1.1.{a}.{b}") for a in range(1, 9) for b in range(1, 9)]
                                     + [("first_m", f"name{k}") for k in range(60)], "kind string, value string")
    got = surrogates.draw_surrogates(entities).collect()
    old = {r["value"] for r in got}
    assert len({(r["kind"], r["new"]) for r in got}) == len(got) == 124 and not old & {r["new"] for r in got}


@pytest.mark.parametrize("name", list(registry.SQL))
def test_queries_match_sql(spark, name):
    class Entry:
        sql = registry.SQL[name]

    problems, odd, _ = compare(connect(h.FOLDER), Entry, registry.QUERIES[name](spark, h.FOLDER))
    assert not problems and not odd


# The search for hard negatives answers anchors; its rows are compared with SQL in test_negatives.
@pytest.mark.parametrize("name", [n for n in registry.QUERIES if n != "op12_hard_negatives"])
def test_every_document_has_its_row(spark, name):
    df = registry.QUERIES[name](spark, h.FOLDER)
    key = next(c for c in df.columns if c in ("doc_id", "vec_id", "page_id"))
    folder = {"doc_id": "documents", "vec_id": "embeddings", "page_id": "pages"}[key]
    ids = [r[0] for r in spark.read.parquet(f"{h.FOLDER}/{folder}.parquet").select(key).collect()]
    assert sorted({r[0] for r in df.select(key).collect()}) == sorted(ids)


def test_quality_rules_run_no_python(spark):
    plan = line_frequency.judge(h.table(spark))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_first_stage_takes_frequent_lines_out(spark):
    """Against brute force: lines in more than 30 distinct texts and 3 % of a host's leave all but its first document."""
    rows = [(k, f"Menu  {k % 10} of the SITE\n" + h.prose(40, k) + "\nFooter line", "a" if k % 3 else None) for k in range(120)]
    rows += [(200 + k, "Copied line\n" + h.prose(40, 999), "a") for k in range(40)] + [(300, "Menu 1 of the site\nfooter line\nshort", "a")]
    rows += [(400, h.prose(30, 8) + "\nFOOTER LINE", "b"), rows[5], rows[5]]

    def normal(line):
        return re.sub("[1-9]", "0", " ".join(h.words(h.lower(line))))

    texts, first = {}, {}
    for d, t, s in rows:
        for x in {normal(x) for x in t.split("\n") if h.words(x)}:
            texts.setdefault((s, x), set()).add(t)
            first[s, x] = min(d, first.get((s, x), d))
    totals = {s: len({t for _, t, z in rows if z == s}) for s in ("a", "b", None)}
    expected = []
    for d, t, s in rows:
        lines = [x for x in t.split("\n") if not (h.words(x) and len(texts[s, normal(x)]) > max(30, 0.03 * totals[s]) and d != first[s, normal(x)])]
        if d != 300:
            expected.append((d, "\n".join(lines), len("\n".join(lines))))
    got = sorted((r["doc_id"], r["text"], r["n_chars"]) for r in corpus_pipeline.quality_rules(spark, h.table(spark, rows), h.FOLDER).collect())
    assert got == sorted(expected)
    assert sum(t != dict((d, t) for d, t, _ in rows)[d] for d, t, _ in got) > 100


def test_pipeline(spark):
    rows = [(d, t, s) for d, t, s in h.corpus()] + [(None, h.prose(50, 8), "a"), (900, h.prose(80, 900) + " password: abcDEF123456 end", "a")]
    docs = h.table(spark, rows)
    columns = docs.columns
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, keep(stage(spark, docs, h.FOLDER))
        seen[name] = [r.asDict() for r in docs.collect()]
        if name != "packing":
            assert docs.columns == columns
    kept = {d: not (len(h.words(t)) < 10) for d, t, _ in rows if d is not None}
    ids = {r["doc_id"] for r in seen["quality_rules"]}
    assert ids <= {d for d, ok in kept.items() if ok} and {7, 8, 9, 100, 200, 900} <= ids and 10 not in ids
    groups = h.near_duplicates([(r["doc_id"], r["text"], None) for r in seen["quality_rules"]], 5, 80)
    assert sorted(r["doc_id"] for r in seen["near_duplicates"]) == sorted(d for d, g in groups.items() if g[2])
    assert len(seen["secret_scan"]) == len(seen["near_duplicates"]) and "abcDEF123456" not in str(seen["secret_scan"])
    assert {r["doc_id"] for r in seen["packing"]} == {r["doc_id"] for r in seen["source_mix"]}
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, h.table(spark, []), h.FOLDER).count() == 0
