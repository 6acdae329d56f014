"""Parts of pages that are missing, doubled or out of order."""

from pyspark.sql import functions as F

from acreage.sources import pages as P


def one(spark, **columns):
    return spark.range(1).select(*(c.alias(n) for n, c in columns.items())).first()


def facts(spark, html):
    return tuple(one(spark, **P.lot_facts(F.lit(html))))


def test_lot_facts(spark):
    block = lambda inside, name="_66d543c": f'<div class="{name}">{inside}</div>'
    assert facts(spark, "no facts") == (None, None, [], [])
    assert facts(spark, None) == (None, None, [], [])
    assert facts(spark, block("<b>Size</b>\n 1,200.5 Acres ") + block("<b>TYPE:</b> none") + block("plain")) == (1200.5, "acres", [], [])
    assert facts(spark, block("<b>Size:</b>3 rods") + block("<b>size:</b>5 Acres", "x _66d543c y") + block("<b>Size:</b>9 km", "_66d543c2")) == (5.0, "acres", [], [])  # the last one; the class is a whole word
    assert facts(spark, block("<b>Type: </b><a>A<i>x</i></a><a href='b'> B </a><abbr>no</abbr>"))[2] == ["Ax", "B"]


def test_where_a_home_page_lies(spark):
    """A rented building's cache first, if it has the right key; then either place of the client's cache; else nothing."""
    home = lambda text: one(spark, a=F.try_variant_get(P.home_page(F.try_parse_json(F.lit(text))), "$.p", "int")).a
    cache = '{"pageProps": {"gdpClientCache": "{\\"k\\": {\\"p\\": 2}}"}}'
    assert home('{"apiCache": "{\\"a\\": {\\"p\\": 5}, \\"xForRentDoubleScrollFullRenderQuery{1}\\": {\\"p\\": 1}}", "props": ' + cache + "}") == 1
    assert home('{"apiCache": "{\\"a\\": {\\"p\\": 5}}", "props": ' + cache + "}") == 2
    assert home('{"props": {"pageProps": {"componentProps": {"gdpClientCache": "{\\"k\\": {\\"p\\": 3}}"}}}}') == 3
    assert home('{"props": {}}') is None and home("{bad") is None


def test_listing_types(spark):
    r = one(spark, a=P.listing_type(F.lit("https://e.org/xml/for-sale-by-agent.xml.gz")), b=P.listing_type(F.lit("plain")), c=P.listing_type(F.lit(None).cast("string")))
    assert tuple(r) == ("for-sale-by-agent", "plain", None)
