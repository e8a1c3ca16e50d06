from vacanta.operators import cards

HTML = """<html><body>
<ul><li class="post-id"><h2><a class="titreJob" href="/offre/1">Data Engineer H/F</a></h2>
  <div class="holder"><div class="text-holder"><p>Acme &amp; Co</p></div>
  <div class="info"><ul><li>CDI</li><li>Rabat</li></ul><div class="text">Stage de 6 mois</div></div></div></li>
<li class="post-id"><h2>no link here</h2></li>
<li class="post-id"><a class="titreJob" href="https://other.example/offre/2">BI</a><p>unclosed
</ul>
<article><a href="/emploi/3">Analyste BI chez X</a> recrute <b>vite</article>
<article><a href="/blog/4">Not a job</a></article>
<div class="post"><a href="/emploi/5">Dev</a></div>
</body></html>"""


def test_first_source_cards():
    rows = cards.cards_of_page(1, "https://site.example/search?p=1", HTML, cards.SOURCE_CARD_SPECS["rekrute_scraper"])
    assert [r[2] for r in rows] == ["https://site.example/offre/1", "https://other.example/offre/2"]
    first = rows[0]
    assert first[3] == "Data Engineer H/F" and first[4] == "Acme & Co"
    assert first[5] == "CDI | Rabat" and first[6] == "Stage de 6 mois"
    assert rows[1][4] is None and rows[1][6] == ""


def test_third_source_cards_url_rule():
    rows = cards.cards_of_page(1, "https://site.example/", HTML, cards.SOURCE_CARD_SPECS["dreamjob_scraper"])
    assert [(r[2], r[3]) for r in rows] == [("https://site.example/emploi/3", "Analyste BI chez X"),
                                            ("https://site.example/emploi/5", "Dev")]
    assert rows[0][7] == "Analyste BI chez X recrute vite"


def test_no_card_and_extract_cards(spark):
    assert cards.cards_of_page(1, "https://s/", "<p>nothing</p>", cards.CardSpec(card="article")) == []
    pages = spark.createDataFrame([(1, "https://site.example/a/b", HTML), (2, "https://s/", "")],
                                  "page_id long, url string, html string")
    got = cards.card_fields(cards.extract_cards(pages, cards.SOURCE_CARD_SPECS["dreamjob_scraper"]),
                            min_title=5, summary_chars=10).collect()
    assert [(r.job_url, r.title, r.summary) for r in got] == [
        ("https://site.example/emploi/3", "Analyste BI chez X", "Analyste B")]


def test_capture_text_and_metadata(spark):
    from pyspark.sql import functions as F

    pages = spark.createDataFrame([(1, "https://site.example/search", HTML)], "page_id long, url string, html string")
    raw = cards.extract_cards(pages, cards.SOURCE_CARD_SPECS["rekrute_scraper"])
    got = cards.card_fields(raw, snippet_summary=True).collect()[0]
    assert got.summary == "Stage de 6 mois" and got.raw_metadata == "CDI | Rabat"
    tag_text, rule_text = cards.capture_text("rekrute_scraper")
    r = raw.select(tag_text.alias("a"), rule_text.alias("b")).collect()[0]
    assert r.b == "Data Engineer H/F Acme & Co CDI | Rabat Stage de 6 mois"
    assert r.a == "Data Engineer H/F " + r.b
    tagged = cards.card_fields(raw, metadata="Emploi | kw=data").select("raw_metadata").distinct().collect()
    assert [x.raw_metadata for x in tagged] == ["Emploi | kw=data"]
    assert F is not None


def test_tag_soup():
    deep = "<div>" * 3000 + "<li class='post-id'><a class='titreJob' href='/offre/1'>Deep one</a>"
    spec = cards.SOURCE_CARD_SPECS["rekrute_scraper"]
    assert [r[3] for r in cards.cards_of_page(1, "https://s/", deep, spec)] == ["Deep one"]
    bad = "<ul><li class='post-id'><a class='titreJob' href='http://[bad'>x</a><li class='post-id'><a class='titreJob' href='/offre/2'>Second</a> tail<li>other</ul>"
    assert [(r[2], r[7]) for r in cards.cards_of_page(1, "https://s/", bad, spec)] == [("https://s/offre/2", "Second tail")]
    nested = "<ul><li class='post-id'><a class='titreJob' href='/a'>A</a><ul><li>in<li>ner</ul> end<li class='post-id'><a class='titreJob' href='/b'>B</a></ul>"
    assert [r[7] for r in cards.cards_of_page(1, "https://s/", nested, spec)] == ["A in ner end", "B"]


def test_a_batch_is_read_in_slices_of_bounded_bytes():
    import pyarrow as pa

    html = ["x" * 10, None, "y" * 7, "z" * 40, "", "é"]
    batch = pa.RecordBatch.from_arrays([pa.array(range(6)), pa.array(html)], names=["page_id", "html"])
    parts = list(cards.slices(batch, "html", 16))
    assert [p.column("page_id").to_pylist() for p in parts] == [[0, 1], [2], [3], [4, 5]]
    assert [x for p in parts for x in p.column("html").to_pylist()] == html
    assert list(cards.slices(batch.slice(0, 0), "html")) == []
