import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from logweir.__main__ import main
from logweir.plans import access_log, cdn, employees, product_clicks, words
from logweir.sources.files import ACCESS_LOG_FIELDS


def rows(df, *cols):
    return sorted((tuple(r) for r in (df.select(*cols) if cols else df).collect()), key=repr)


def click(domain, resource, traffic, hour="2019050603"):
    return f"edge,CN,3,{hour}0101,10.0.0.1,{domain},http://{domain}/{resource},{traffic}"


@pytest.fixture
def click_file(tmp_path):
    four, two = "v.four.example", "v.two.example"
    lines = [click(four, "r82.mp4", 1)] * 4 + [click(four, "r81.mp4", 54476), click(four, "r83.mp4", 54476)]
    lines += [click(two, "r87.mp4?x=1", 1), click(two, "r87.mp4", 1), click(two, "r87.mp4", 1)]
    lines += [click(two, "r86.mp4", 5)] * 2 + [click(two, "r85.mp4", 54476)]
    lines += ["short,line", click(two, "r86.mp4", "none")]
    path = tmp_path / "clicks.log"
    path.write_text("\n".join(lines))
    return str(path)


def test_cdn_reports(spark, click_file):
    clicks = cdn.read_clicks(spark, click_file)
    totals = cdn.resource_totals(clicks)
    top = {(r.domain, r.rank): (r.resource, r.hits, r.traffic) for r in cdn.top_resources(totals, "hits", 2).collect()}
    assert top == {
        ("v.four.example", 1): ("/r82.mp4", 4, 4),
        ("v.four.example", 2): ("/r81.mp4", 1, 54476),
        ("v.two.example", 1): ("/r86.mp4", 3, 10),
        ("v.two.example", 2): ("/r87.mp4", 3, 3),
    }
    by_traffic = cdn.top_resources(totals, "traffic", 1)
    assert rows(by_traffic, "domain", "resource") == [("v.four.example", "/r81.mp4"), ("v.two.example", "/r85.mp4")]
    assert rows(cdn.hourly_traffic(clicks)) == [
        ("v.four.example", "2019050603", 108956), ("v.two.example", "2019050603", 54489)]


def test_cdn_code_mode_keeps_query(spark, click_file):
    totals = cdn.resource_totals(cdn.read_clicks(spark, click_file), "code")
    assert ("v.two.example", "r87.mp4?x=1", 1, 1) in rows(totals)


def test_cdn_top_urls(spark, click_file):
    top = cdn.top_urls(cdn.read_clicks(spark, click_file), "2019-05-21", 1)
    assert rows(top, "url", "num", "day", "rank") == [
        ("http://v.four.example/r82.mp4", 4, "2019-05-21", 1), ("http://v.two.example/r86.mp4", 3, "2019-05-21", 1)]


def test_cdn_run(spark, click_file, tmp_path):
    out = str(tmp_path / "out")
    cdn.run(spark, click_file, out, n=1)
    assert rows(spark.read.text(f"{out}/top_hits")) == [
        ("v.four.example,/r82.mp4,4,4,1",), ("v.two.example,/r86.mp4,3,10,1",)]
    assert spark.read.text(f"{out}/top_traffic").count() == 2
    assert spark.read.text(f"{out}/hourly").count() == 2


def test_cdn_top_with_a_hot_domain(spark):
    rng = random.Random(3)
    data = [("hot" if i % 3 == 0 else f"d{rng.randrange(9)}", f"r{rng.randrange(30)}", rng.randrange(100)) for i in range(3000)]
    clicks = spark.createDataFrame(data, "domain string, r string, traffic long").repartition(5)
    totals = cdn.resource_totals(clicks.withColumn("url", F.concat(F.lit("http://"), "domain", F.lit("/"), "r")))
    count, traffic = Counter(), Counter()
    for domain, resource, amount in data:
        count[domain, "/" + resource] += 1
        traffic[domain, "/" + resource] += amount
    groups = defaultdict(list)
    for (domain, resource), hits in count.items():
        groups[domain].append((-hits, resource, traffic[domain, resource]))
    wanted = [(d, r, -h, t, i) for d, g in groups.items() for i, (h, r, t) in enumerate(sorted(g)[:10], 1)]
    assert rows(cdn.top_resources(totals, "hits")) == sorted(wanted, key=repr)


def access_line(cdn_name, traffic):
    fields = ["-"] * 72
    known = {"cdn": cdn_name, "region": "CN", "level": "E", "time": "[20190101010101 +0800]", "ip": "10.0.0.1",
             "domain": "v2.example", "url": "http://v1.example/a.mp4", "traffic": traffic}
    for name, value in known.items():
        fields[ACCESS_LOG_FIELDS[name]] = value
    return "\t".join(fields)


def test_access_log(spark, tmp_path):
    lines = [access_line("edge", "16384")] * 4 + [access_line("e1", "0"), access_line("e2", "0"), access_line("e3", "-1")]
    source = tmp_path / "raw.txt"
    source.write_text("\n".join(lines))
    access_log.run(spark, str(source), str(tmp_path / "paid"))
    cleaned = "edge,CN,E,20190101010101,10.0.0.1,v2.example,http://v1.example/a.mp4,16384"
    assert rows(spark.read.text(str(tmp_path / "paid"))) == [(cleaned,)] * 4
    access_log.run(spark, str(source), str(tmp_path / "all"), keep_all=True)
    assert spark.read.text(str(tmp_path / "all")).count() == 7
    parsed = access_log.paid_traffic(spark.read.text(str(source)))
    assert rows(cdn.resource_totals(parsed), "resource") == [(None,)]


def test_access_log_bad_lines(spark):
    short = spark.createDataFrame([("a\tb",), (access_line("edge", "1"),)], "value string")
    assert access_log.paid_traffic(short).count() == 1
    with pytest.raises(Exception, match="INVALID_ARRAY_INDEX"):
        access_log.clean_lines(short).collect()
    bad = spark.createDataFrame([(access_line("edge", "x"),)], "value string")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        access_log.paid_traffic(bad).collect()


@pytest.fixture(scope="module")
def shop(spark):
    rng = random.Random(5)
    city_ids = [1] * 4 + list(range(2, 10))
    data = [(rng.choice(city_ids), rng.randrange(12)) for _ in range(2000)]
    clicks = spark.createDataFrame(data, "c_city_id int, c_product_id int").repartition(4)
    cities = spark.createDataFrame([(i, f"c{i}", f"area{i % 3}") for i in range(1, 9)], "city_id int, city_name string, area string")
    info = ['{"product_status": 1}', '{"product_status": 0}', "{}", None]
    products = spark.createDataFrame(
        [(i, f"p{i}", info[i % 4]) for i in range(10)], "product_id int, product_name string, extend_info string")
    count = Counter((f"area{c % 3}", p) for c, p in data if c < 9 and p < 10)
    wanted = []
    for area in {a for a, _ in count}:
        best = sorted((-n, p) for (a, p), n in count.items() if a == area)[:3]
        wanted += [(p, f"p{p}", [1, 0, -1, -1][p % 4], area, -n, "2016-05-05", i) for i, (n, p) in enumerate(best, 1)]
    return clicks, cities, products, sorted(wanted, key=repr)


@pytest.mark.parametrize("small", [True, False])
def test_product_clicks(shop, monkeypatch, small):
    clicks, cities, products, wanted = shop
    monkeypatch.setattr(product_clicks, "is_small", lambda df: small)
    monkeypatch.setattr(product_clicks, "local_copy", lambda df: None)
    assert rows(product_clicks.top_products(clicks, cities, products, "2016-05-05")) == wanted
    monkeypatch.undo()
    top = product_clicks.top_products(clicks, cities, products, "2016-05-05")
    assert top.columns == product_clicks.COLUMNS
    assert [f.dataType.simpleString() for f in top.schema] == ["int", "string", "int", "string", "bigint", "string", "int"]
    assert rows(top) == wanted


def test_employees(spark, tmp_path):
    source, out = tmp_path / "2019060810", str(tmp_path / "col")
    source.mkdir()
    lines = ["10\tname10\t2019-06-08 10:40:39\t8332", "x\tbad id\t2019-06-08 10:40:39\t1", "11\ttwo fields",
             "12\tbad pay\t2019-06-08 09:00:00\tlots", "13\tno pay\t2019-06-08 09:00:00", "14\tbad time\tsoon\t5", ""]
    (source / "part-0").write_text("\n".join(lines) + "\n")
    assert employees.run(spark, str(source), out) == {"total": 7, "errors": 3}
    wanted = [
        (10, "name10", 1559990439000, 8332.0, "20190608", "10"),
        (12, "bad pay", 1559984400000, 0.0, "20190608", "09"),
        (13, "no pay", 1559984400000, 0.0, "20190608", "09"),
        (14, "bad time", 0, 5.0, "19700101", "00"),
    ]
    columns = ["id", "name", "time", "salary", "day", "hour"]
    assert rows(employees.read_employees(spark, out), *columns) == wanted
    employees.run(spark, str(source), out, gather=False)
    assert rows(employees.read_employees(spark, out), *columns) == wanted
    late = tmp_path / "2019060811"
    late.mkdir()
    (late / "part-0").write_text("15\tlate\t2019-06-08 10:59:59\t7\n")
    assert employees.run(spark, str(late), out) == {"total": 1, "errors": 0}
    both = employees.read_employees(spark, out)
    assert rows(both.filter("day = '20190608' AND hour = '10'"), "id", "batch") == [
        (10, "2019060810"), (15, "2019060811")]
    assert both.count() == 5
    with pytest.raises(ValueError, match="name the batch"):
        employees.run(spark, f"{tmp_path}/2019*", out)


def test_words(spark, tmp_path):
    lines = spark.createDataFrame([("b a  a",), ("a b c",)], "value string")
    assert [tuple(r) for r in words.sorted_word_count(lines).collect()] == [("a", 3), ("b", 2), ("c", 1)]
    views = spark.createDataFrame([("u1,p1",), ("u2,p2,x",), ("u3,p2",)], "value string")
    assert [tuple(r) for r in words.page_view_rank(views).collect()] == [("p2", 2), ("p1", 1)]
    source = tmp_path / "in.txt"
    source.write_text("a b\na\n")
    words.run(spark, str(source), str(tmp_path / "out"))
    assert rows(spark.read.text(str(tmp_path / "out"))) == [("a\t2",), ("b\t1",)]


def test_command_line(spark, tmp_path, capsys):
    source = tmp_path / "in.txt"
    source.write_text("u1,p1\nu2,p2\nu3,p2\n")
    main(["page-views", str(source), str(tmp_path / "views")])
    assert rows(spark.read.text(str(tmp_path / "views"))) == [("p1\t1",), ("p2\t2",)]
    source.write_text("10\tn\t2019-06-08 10:40:39\t1\n")
    main(["employees", str(source), str(tmp_path / "col")])
    assert "'total': 1" in capsys.readouterr().out
    with pytest.raises(SystemExit):
        main(["other", "a", "b"])
