"""Templates of hosts with odd pages, and names that only look like side matters."""

import pytest

from cohortline.llm import page_text


def test_odd_pages_do_not_undo_a_template(spark):
    built = "<html><body><p>Always here</p><div><p>Body {n}</p></div><p>Bottom line</p></body></html>"
    pages = [(i, f"https://a.org/{i}", built.format(n=i)) for i in range(20)]
    pages += [(20, "https://a.org/20", None), (21, "https://a.org/21", ""), (22, "https://a.org/22", "<p>Other</p>")]
    pages += [(23, "https://a.org/23", "<html><body><p>Always here</p><div><p>Cut")]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string")
    found = {r.page_id: r.text for r in page_text.main_text(frame).collect()}
    assert all(found[i] == f"Body {i}" for i in range(20))
    assert found[20] == found[21] == "" and found[22] == "Other" and found[23] == "Cut"


@pytest.mark.parametrize(
    "page",
    [
        "<div class='layout no-sidebar'><p>a</p><p>b</p></div>",
        "<article class='post share-enabled'><p>a</p><p>b</p></article>",
        "<article><section id='discussion'><p>a</p></section><h2 id='related-work'>b</h2></article>",
        "<article><h2 class='notice'>a</h2><p>b</p></article>",
        "<div class='sidebar'><main><p>a</p><p>b</p></main></div>",
        "<article class='post'><p>a</p><p>b</p><div class='comments'><article class='comment'>c</article></div></article>",
        "<article><p>a</p><p>b</p></article><div class='related'><article>teaser</article></div>",
        "<article><p>a</p><div class='ad-slot'>buy</div><p>b</p><div class='cookie-notice'>c</div></article>",
    ],
)
def test_only_whole_names_are_side_matters(page):
    assert page_text.page_text(f"<html><body>{page}</body></html>") == "a b"


def test_classes_of_equal_vectors_are_nested(spark):
    # Items differ in number, each ends in the same words; the words of a shuffled pair have no order.
    item = "<li><p>Story {n}.{i}</p><b></b><p>Read more</p></li>"
    pairs = ("Alpha Beta Alpha Beta", "Beta Alpha Beta Alpha", "Alpha Beta Beta Alpha")
    pages = []
    for n in range(24):
        items = "".join(item.format(n=n, i=i) for i in range(2 + n % 3))
        odd = "".join(f"<p>{w}</p>" for w in pairs[n % 3].split())
        pages.append((n, f"https://a.org/{n}", f"<html><body><h1>Top</h1><ul>{items}</ul><div>{odd}</div></body></html>"))
    frame = spark.createDataFrame(pages, "page_id long, url string, html string")
    found = {r.page_id: r.text for r in page_text.main_text(frame).collect()}
    for n in range(24):
        stories = " ".join(f"Story {n}.{i}" for i in range(2 + n % 3))
        assert found[n] == f"{stories} {pairs[n % 3]}"


def test_walk_tells_nested_from_overlapping_classes():
    template = page_text.Template([1, 9], [[2, 3], [4, 5]])
    walk = page_text.Walk(template)
    assert all(map(walk.step, (1, 2, 4, 5, 4, 5, 3, 2, 4, 5, 3, 9)))
    assert walk.inside == {0: {(-1, 0)}, 1: {(0, 1)}} and not walk.bad
    walk = page_text.Walk(template)
    for key in (1, 2, 4, 3, 5, 9):
        walk.step(key)
    assert walk.bad == {1}
    # What lies in an invalid class, or elsewhere than on most pages, is no template.
    assert not page_text.Template([1], [[2, 3], [4, 5]], [None, (0, 1)]).members
    walk = page_text.Walk(page_text.Template([1, 9], [[2, 3], [4, 5]], [(-1, 0), (0, 1)]))
    assert [walk.step(k) for k in (1, 4, 5, 2, 4, 5, 3, 9)] == [True, False, False, *[True] * 5]
