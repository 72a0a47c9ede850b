"""Price tables with spans, nested in others, and never closed."""

import pytest

from martkit.sources import html
from martkit.sources.tables import tables

DAY = "<tr><td>24/08/2569</td><td>29.1</td><td>30.2</td><td>37.69</td></tr>"
PAGES = {
    "spanning header": ("<table><tr><th>Date</th><th colspan=2>Diesel</th><th>Gasohol 95</th></tr>" + DAY + "</table>", [37.69]),
    "two header rows": ("<table><tr><th rowspan=2>Date</th><th colspan=3>Price</th></tr><tr><th>E20</th><th>E85</th><th>Gasohol 95</th></tr>" + DAY + "</table>", [37.69]),
    "spanning date": ("<table><tr><th>Date<th>Town<th>Gasohol95<tr><td rowspan=2>24/08/2569<td>a<td>31<tr><td>b<td>32</table>", [31.0, 32.0]),
    "never closed": ("<table><tr><th>Date<th>E20<th>Gasohol 95<tr><td>24/08/2569<td>30<td>37.5", [37.5]),
    "outer rows": ("<table><tr><th>Date</th><th>Note</th><th>Gasohol 95</th></tr><tr><td>24/08/2569</td><td><table><tr><td>x</td></tr></table></td><td>36</td></tr>"
                   "<tr><td>25/08/2569</td><td>-</td><td>37</td></tr></table>", [36.0, 37.0]),
    "inner table": ("<table><tr><td><table><tr><td>24/08/2569</td><td>38</td></tr><tr><td>25/08/2569</td><td>39</td></tr></table></td></tr></table>", [38.0, 39.0]),
    "as written": ("<table><tr><td colspan=2>24/08/2569</td><td>35</td></tr></table>", [35.0]),
    "odd": ("<![x]><table><script>'<tr><td>24/08/2569<td>33'</script><style/><tr><td>&nbsp;24/08/2569<td>34</table><script><table>", [34.0]),
}


@pytest.mark.parametrize("of", list(PAGES))
def test_price_tables(spark, of):
    pages = spark.createDataFrame([(of, PAGES[of][0]), ("none", None)], "page string, html string")
    got = html.extract_prices(pages).collect()
    assert sorted(r.price for r in got) == PAGES[of][1] and {r.page for r in got} == {of}


def test_grid():
    one, = tables("<table><tr><td rowspan=0>a<td colspan=2 rowspan=2>b<tr><td>c<tbody><tr><td colspan=x>d</table>")
    assert [[c.strip() for c in r["cells"]] for r in one["rows"]] == [["a", "b", "b"], ["a", "b", "b", "c"], ["d"]]
    assert [len(t["rows"]) for t in tables("<table><tr><td>1</td></tr><table><tr><td>2")] == [1, 1]
