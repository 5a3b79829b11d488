import json
import random

from pyspark.sql import functions as F

from tidewire.sources.navigation import MAX_NODES, declared_navigation, menu_links


def plain(data):
    """(place, title, url, gender) of a menu, walked node by node."""
    out = []

    def gender_of(title):
        return {"men": "mens", "mens sports": "mens", "women": "womens", "womens varsity": "womens"}.get(title.lower().replace("'", ""))

    def walk(nodes, group, place, depth):
        if not isinstance(nodes, list) or depth > 6:
            return
        columns, section = {}, group
        for i, node in enumerate(nodes):
            if not isinstance(node, dict):
                continue
            title = node["title"] if isinstance(node.get("title"), str) else ""
            title = " ".join(title.split())
            said = gender_of(title)
            column = node.get("column")
            column = column if isinstance(column, int) and not isinstance(column, bool) and 0 <= column <= 20 else None
            if said or node.get("separator") is True:
                section = said or group
                if column is not None:
                    columns[column] = section
            gender = section if column is None else columns.get(column, group)
            if isinstance(node.get("url"), str) and title:
                out.append((".".join(map(str, [*place, i])), title, node["url"], gender))
            walk(node.get("items"), gender, [*place, i], depth + 1)

    walk(data, None, [0], 0)
    return out


def tree(r, depth=0):
    nodes = []
    for _ in range(r.randrange(1, 7)):
        node = {"title": r.choice(["Men", "Women", "Men's Sports", "Women's Varsity", "Golf", "Tennis", " Track  Field ", "", 5, None])}
        if r.random() < 0.7:
            node["url"] = r.choice(["/sports/golf", "/x", 7])
        if r.random() < 0.5:
            node["column"] = r.choice([0, 1, 2, 21, -1, 1.5, "1", True])
        if r.random() < 0.2:
            node["separator"] = r.choice([True, False, "true"])
        if depth < 8 and r.random() < 0.5:
            node["items"] = tree(r, depth + 1)
        nodes.append(r.choice([node] * 9 + ["text", 3, None, []]))
    return nodes


def rows(spark, pages):
    df = spark.createDataFrame(list(pages.items()), "id int, text string")
    out = {}
    for x in declared_navigation(df, "id").orderBy("id", "place").collect():
        place = ".".join(map(str, x.place)) if x.place else None
        out.setdefault(x.id, []).append(x.error_code or (place, x.title, x.url, x.gender))
    return out


def page(data, more=""):
    return f"<script>{more}var obj = {json.dumps({'type': 'main-navigation', 'data': data})};</script>"


def test_equals_a_walk(spark):
    r = random.Random(5)
    trees = {i: tree(r) for i in range(60)}
    got = rows(spark, {i: page(t) for i, t in trees.items()})
    assert {i: got.get(i, []) for i in trees} == {i: plain(t) for i, t in trees.items()}


def test_other_scripts_and_bounds(spark):
    link = {"title": "Golf", "url": "/g"}
    many = [link] * (MAX_NODES + 1)
    pages = {
        1: "<p>var obj = {}</p>", 2: '<script>var obj = {"type": "stories", "data": [{"title": "x", "url": "/"}]}</script>', 3: "<script>var obj = {broken</script>",
        4: page(many), 5: page(many[:-1]), 6: page([link]) + page([link, link]), 7: page([link, {"title": "Open", "url": "/x" * 1100}], "var s = '{';"), 8: None,
        9: page([{"title": "a", "items": many[:3001]}, {"title": "b", "items": many[:3000]}]), 10: page({"title": "x"}),
    }
    got = rows(spark, pages)
    assert got[4] == got[9] == ["source-format-changed"] and len(got[5]) == MAX_NODES and {1, 2, 3, 8, 10}.isdisjoint(got)
    assert [x[0] for x in got[6]] == ["0.0", "1.0", "1.1"] and len(got[7]) == 1


def test_links_for_sports(spark):
    data = [{"title": "Women", "items": [{"title": "Golf", "url": "/sports/womens-golf"}, {"title": "Roster for Men's Golf", "url": "/sports/mens-golf/roster"}]}]
    df = spark.createDataFrame([("s", page(data))], "school string, text string")
    got = [(x.pos, x.label, x.section) for x in menu_links(df, "school").orderBy("pos").collect()]
    assert got == [(0, "womens Golf", "womens"), (1, "Men's Golf", "womens")]
    assert declared_navigation(df.where(F.lit(False)), "school").count() == 0
