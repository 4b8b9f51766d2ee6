"""Main text of pages and tool calls in chats."""

import html
import json
import random
import re

import pytest
from pyspark.sql import functions as F

from cohortline.llm import page_text, tool_calls
from tests.llm.conftest import SF, rows

PAGE = """<!doctype html><html><head><title>T</title><style>p{{}}</style></head><body>
<header class=top><a href="/">Site {n}</a></header><nav><ul><li>Home</li><li>News {n}</li></ul></nav>
<div class="cookie-notice">We use cookies</div><div class="ad">Buy {n}</div>
{open}<h1>Title&nbsp;{n}</h1><p>First <b>bold</b>ness &amp; {n}<br>more<p>Same on all pages
<script>var x = "<p>no</p>";</script><ul><li>item<li>other</ul>
<div class="comments"><p>Nice {n}</p></div>{close}
<aside>Related {n}</aside><form>Mail <input> {n}</form><!-- note --><footer>&copy; {n}</footer></body>"""


def test_article_without_its_surroundings():
    page = PAGE.format(n=7, open="<article>", close="</article>")
    said = "Title 7 First boldness & 7 more Same on all pages item other"
    assert page_text.page_text(page) == said
    bare = PAGE.format(n=7, open="<div id=x>", close="</div>")
    assert page_text.page_text(bare) == said
    for odd in (None, "", "<", "plain", "a < b", "<p", "<div", "</p></p>", "<a href='x>y", "&amp", "<!-- x"):
        page_text.page_text(odd)
    assert page_text.page_text("plain &lt;b&gt; \n text") == "plain <b> text"
    assert page_text.page_text("x" * 300_000 + "<p>" * 2000) == "x" * 300_000


def test_template_text_goes_where_there_is_no_article(spark):
    pages = [
        (i, f"https://a.org/{i}", PAGE.format(n=i, open="<div id=x>", close="</div>") + "<p>Always here</p>")
        for i in range(20)
    ]
    odd = [(None, None, None), (1, "http://b.org", ""), (2, "nonsense", "<p>t"), (3, "https://a.org/3", pages[3][2])]
    frame = spark.createDataFrame(pages + odd, "page_id long, url string, html string").selectExpr("*", "1 AS text", "2 AS host")
    found = {(r.page_id, r.url): r.text for r in page_text.main_text(frame).collect()}
    # Everything that all pages share is gone, list items and a paragraph too.
    assert found[5, "https://a.org/5"] == "Title 5 First boldness & 5 more"
    assert found[None, None] == found[1, "http://b.org"] == "" and found[2, "nonsense"] == "t"
    assert page_text.main_text(frame).count() == 24
    assert page_text.main_text(frame.limit(0)).count() == 0
    template = dict(page_text.templates(page_text._with_host(frame)).collect())
    assert set(template) == {"a.org"} and page_text._key("/html/p Always here") in template["a.org"]


def test_given_pages(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    for page_id, said in page_text.main_text(pages).select("page_id", "text").collect():
        page = pages.filter(f"page_id = {page_id}").first().html if page_id % 10 == 0 else None
        if page:
            inner = re.search(r"<article>(.*)</article>", page, re.S)[1]
            blocks = re.split(r"</?(?:p|h1)>|<br>", inner)
            plain = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in blocks]
            assert said == " ".join(b for b in plain if b)


def calls(*items):
    return json.dumps({"tool_calls": list(items)})


SCHEMAS = {"f": {"q": ("string", True), "k": ("number", False)}, "g": {"x": ("integer", True)}}


@pytest.fixture(scope="module")
def chats(spark):
    told = [
        (1, 0, "user", "hi"),
        (1, 1, "assistant", calls({"id": "b", "name": "g", "arguments": {"x": 1}, "after": ["a", "none"]},
                                  {"id": "a", "name": "f", "arguments": '{"q": "z", "k": 2.50}'})),
        (1, 3, "tool", json.dumps({"tool_call_id": "a", "content": "late"})),
        (1, 2, "tool", json.dumps({"tool_call_id": "a", "content": "ra"})),
        (1, 4, "tool", json.dumps({"tool_call_id": "zz", "content": "?"})),
        (2, 0, "assistant", calls({"id": "p", "name": "g", "arguments": {"x": "s"}, "after": ["q"]},
                                  {"id": "q", "name": "h", "arguments": [], "after": ["p"]},
                                  {"name": "f", "arguments": "{"}, {"id": "r", "name": "f", "arguments": {"k": None, "o": 1}})),
        (None, None, None, None),
        (3, 0, "assistant", "{bad"),
        (3, 0, "assistant", "{bad"),
        (3, 1, "assistant", ""),
    ]
    return spark.createDataFrame(told, "conv_id long, turn long, role string, text string").selectExpr("*", "1 AS level", "2 AS place")


def test_tool_calls(chats):
    found = tool_calls.format_chats(chats, SCHEMAS)
    by = {(r.conv_id, r.call_id, r.kind): r for r in found.collect()}
    assert found.count() == 12
    a, b = by[1, "a", "call"], by[1, "b", "call"]
    assert a.linked and a.errors == "" and not b.linked and a.seq < b.seq
    assert a.record == '{"call":{"arguments":{"k":2.5,"q":"z"},"id":"a","name":"f"},"result":{"content":"ra","turn":2},"turn":1}'
    assert by[1, "zz", "orphan"].errors == "no call"
    assert by[2, "p", "call"].errors == "type of x; cycle" and by[2, "q", "call"].errors == "unknown tool; cycle"
    assert by[2, None, "call"].errors == "not JSON"
    assert by[2, "r", "call"].errors == "missing q; type of k; unknown o"
    assert by[None, None, "message"].record == '{"content":null,"role":null,"turn":null}'
    for conv in (1, 2, 3, None):
        places = sorted(r.seq for r in found.collect() if r.conv_id == conv)
        assert places == list(range(len(places)))
    assert tool_calls.format_chats(chats.limit(0), SCHEMAS).count() == 0


def test_levels_of_a_long_chain(spark):
    chain = [(1, f"c{i}", [f"c{i - 1}"] if i else []) for i in range(6)] + [(1, "d", ["c5", "c1"])]
    frame = spark.createDataFrame(chain, "conv_id long, call_id string, needs array<string>")
    want = [(1, f"c{i}", i) for i in range(6)] + [(1, "d", 6)]
    assert rows(tool_calls.levels(frame)) == sorted(want, key=repr)


def test_exchanges_need_the_reply_before(spark):
    told = [(c, t, ("user", "assistant")[t % 2], f"{t}") for c in (1, 2) for t in range(40) if (c, t) != (2, 20)]
    frame = spark.createDataFrame([*told, (None, 0, "user", "x")], "conv_id long, turn long, role string, text string")
    calls, results, other = tool_calls.exchanges(frame)
    level = {(r.conv_id, r.call_id): r.level for r in tool_calls.levels(calls).collect()}
    assert level[1, "reply-38"] == 19 and level[2, "reply-38"] == 8 and level[None, "reply-0"] == 0
    found = tool_calls.link_calls(calls, results, other, tool_calls.REPLY).collect()
    assert len(found) == 41
    # A call that is told before the one it needs stands behind it, and what follows stays where it was.
    swapped = calls.withColumn("turn", F.when(F.col("call_id") == "reply-6", 1).otherwise(F.col("turn")))
    found = tool_calls.link_calls(swapped, results, other, tool_calls.REPLY).filter("conv_id = 1 and kind = 'call'")
    assert [r.call_id for r in found.orderBy("seq").collect()] == [f"reply-{t}" for t in range(0, 40, 2)]


def test_levels_of_many_shapes(spark):
    rng = random.Random(3)
    calls, want = [], {}
    for conv in range(30):
        names, shape = rng.sample(range(100), 25), conv % 3
        needs = {n: [rng.choice(names[:i]) for _ in range(rng.randint(0, (1, 3, 2)[shape]))] for i, n in enumerate(names) if i}
        needs[names[0]] = [names[rng.randrange(1, 25)]] if conv % 5 == 0 else []
        place = {n: rng.randrange(50) for n in names}
        calls += [(conv, str(n), [str(x) for x in needs[n]] + ["none"], place[n], 0) for n in names]

        def settle(n, on=()):
            if n in on:
                return None
            told = [settle(x, (*on, n)) for x in needs[n]]
            return None if None in told else (max([t[0] + 1 for t in told], default=0), max([place[n], *[t[1] for t in told]]))

        want |= {(conv, str(n)): settle(n) for n in names}
    frame = spark.createDataFrame(calls, "conv_id long, call_id string, needs array<string>, turn long, place int")
    found = {(r.conv_id, r.call_id): r for r in tool_calls.settled_calls(frame).collect()}
    assert {k: r.level if r.level is None else (r.level, r.behind.turn) for k, r in found.items()} == want
    assert any(v is None for v in want.values()) and max(v[0] for v in want.values() if v) > 5
