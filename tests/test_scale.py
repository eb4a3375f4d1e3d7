"""How much the large jobs move and how often they read a table."""

import hashlib
from collections import Counter

from pyspark.sql import functions as F

from conftest import rows
from millrace.functions.keys import packed_hex, packed_key, row_hash, unpacked_hex, unpacked_key
from millrace.operators import quality as q
from millrace.operators import textindex
from millrace.plans import dimensions as d
from millrace.plans import facts as f
from millrace.sources.generate import weekly_stock


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_packed_keys_come_back_as_they_were(spark):
    values = ["00ff", "abc", "AB", "", None, "zz", "ab\n", "a" * 64]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    packed = df.select("i", "v", packed_hex("v").alias("p"))
    back = packed.select("i", unpacked_hex("p").alias("w"), F.octet_length("p.bytes"))
    assert [r[1] for r in sorted(back.collect())] == values
    assert [r[2] for r in sorted(back.collect())] == [2, None, None, 0, None, None, None, 32]


def events(spark):
    none = F.lit(None).cast("string")
    one = spark.range(1)
    link = {"source_url": none, "source_description": none}
    hashed = {n: [c for c in s.hashed if not c.endswith("_nk")] for n, s in d.INVESTMENT_DIMENSIONS.items()}

    def source(name, **columns):
        return one.select(*[F.lit(v).alias(c) for c, v in columns.items()], *[v.alias(c) for c, v in link.items()],
                          *[none.alias(c) for c in hashed[name] if c not in columns])

    company = spark.createDataFrame([(1, "a"), (2, "b"), (3, "b")], "office_id long, object_id string")
    return {
        "company": company.select("*", *[none.alias(c) for c in hashed["company"]]),
        "acquisition": source("acquisition", acquisition_id=1, acquiring_object_id="a", acquired_object_id="b", acquired_at="2020-01-01"),
        "ipos": source("ipos", ipo_id=1, object_id="a", public_at="2020-01-02"),
        "funds": source("funds", fund_id=1, object_id="a", funded_at="2020-01-03"),
        "milestones": source("milestones", milestone_id=1, object_id="x", milestone_at="2020-01-04"),
        "funding_rounds": source("funding_rounds", funding_round_id=7, funded_at="2020-01-05"),
        "investments": spark.createDataFrame(
            [(1, 7, "a", "b"), (2, 8, "a", None)],
            "investment_id long, funding_round_id long, funded_object_id string, investor_object_id string"),
    }


def test_an_investment_meets_its_round_before_it_becomes_two_events(spark):
    sources = events(spark)
    dims = {n: d.INVESTMENT_DIMENSIONS[n].build(sources[n]) for n in ("company", "funding_rounds")}
    fact = f.company_events(sources, dims)
    lines = optimized(fact).split("\n")
    split = next(i for i, line in enumerate(lines) if "Generate" in line and "funded_object_id" in line)
    assert any("Join" in line and "funding_round_nk" in line for line in lines[split:])
    (key,) = [r[0] for r in dims["funding_rounds"].select("funding_rounds_id").collect()]
    made = fact.where("funding_rounds_id IS NOT NULL").select("funding_rounds_id", "event_type_id", F.to_date("event_datetime").cast("string"))
    labels = {r[0]: r[1] for r in spark.createDataFrame([(x,) for x in f.EVENT_LABELS], "l string").select("l", F.sha2("l", 256)).collect()}
    assert rows(made) == sorted([(key, labels["Received Funding"], "2020-01-05"), *[(key, labels["Made Investment"], "2020-01-05")] * 2])
    # One event a kind and office; the second investment has no round, and its investor is no one.
    assert fact.count() == 1 + 2 + 1 + 1 + 1 + 1 + 2 + 1 + 1


def test_a_key_that_follows_from_its_columns_takes_no_bytes(spark):
    values = ["00ff", "abc", "AB", "", None, "zz", "ab\n", "a" * 64]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string").union(
        spark.range(8, 9).select(F.col("id").cast("int"), row_hash([F.col("id"), F.lit(None)])))
    follows = ["i", F.lit(None)]
    packed = df.select("i", "v", packed_key("v", follows).alias("p"), packed_key("v").alias("q"))
    back = packed.select(
        "i", "v", unpacked_key("p", follows).alias("w"), unpacked_key("q").alias("x"), F.octet_length("p"), F.octet_length("q"))
    found = sorted(back.collect())
    assert [(r.w, r.x) for r in found] == [(r.v, r.v) for r in found] and [r.v for r in found[:8]] == values
    assert [r[4] for r in found] == [3, 4, 3, 1, None, 3, 4, 33, 0]
    assert found[8][5] == 33


def test_events_meet_their_company_before_the_kinds_are_stacked(spark):
    """A stacked event would move the empty columns of six other kinds."""
    sources = events(spark)
    dims = {n: d.INVESTMENT_DIMENSIONS[n].build(sources[n]) for n in ("company", "funding_rounds")}
    lines = optimized(f.company_events(sources, dims)).split("\n")
    union = next(i for i, line in enumerate(lines) if "Union" in line)
    assert not any("Join" in line for line in lines[:union])
    assert sum("Join LeftOuter, (object_nk" in line for line in lines[union:]) == 5


def test_round_keys_are_those_of_the_dimension(spark):
    """Made again from the natural key only where that gives the dimension's own key."""
    n = len(d.INVESTMENT_DIMENSIONS["funding_rounds"].hashed) - 1

    def made(natural):
        return hashlib.sha256("||".join([natural, *["null"] * n]).encode()).hexdigest()

    keys = [(7, made("7")), (7, "odd"), (8, None), (9, "ab" * 32), (None, made("null"))]
    wanted = [(1, made("7")), (1, "odd"), (2, None), (3, "ab" * 32), (4, None), (5, None)]
    sources = events(spark)
    link = ("2020-01-05", None, None)
    for kind, text in (("long", int), ("string", str), ("string", "0{}".format)):
        other = "long" if text not in (int, str) else kind
        read = int if other == "long" else str
        sources["funding_rounds"] = spark.createDataFrame(
            [(read(i), *link) for i in (7, 8, 9)], f"funding_round_id {other}, funded_at string, source_url string, source_description string")
        sources["investments"] = spark.createDataFrame(
            [(i, None if k is None else text(k), "x", "x") for i, k in enumerate((7, 8, 9, 10, None), 1)],
            f"investment_id long, funding_round_id {kind}, funded_object_id string, investor_object_id string")
        rounds = spark.createDataFrame(
            [(None if k is None else read(k), v) for k, v in keys], f"funding_round_nk {other}, funding_rounds_id string")
        company = d.INVESTMENT_DIMENSIONS["company"].build(sources["company"])
        fact = f.company_events(sources, {"company": company, "funding_rounds": rounds})
        paid = fact.where(F.col("event_type_id").isin(*[hashlib.sha256(x.encode()).hexdigest() for x in ("Received Funding", "Made Investment")]))
        assert rows(paid, "funding_rounds_id") == sorted([(v,) for _, v in wanted] * 2, key=lambda r: (r[0] is not None, str(r[0])))
        assert paid.where("event_date = '2020-01-05'").count() == 8


def test_keys_of_own_rows_are_those_of_the_dimension(spark):
    """Whether the key moves or, where they are shorter, the columns it is made of; moments keep their clock."""
    sources = events(spark)
    moments = ["1969-12-31 23:59:59.999999", "2020-01-04 00:00:00", None, "0001-01-01 12:00:00.5"]
    texts = ["short", "a description of more bytes than a hash has", None, "\u00e4" * 16]
    sources["milestones"] = spark.createDataFrame(
        [(i, "b", t, "m", m, None, None) for i, (t, m) in enumerate(zip(texts, moments))],
        "milestone_id long, object_id string, description string, milestone_code string, milestone_at string, source_url string, source_description string")
    dims = {n: d.INVESTMENT_DIMENSIONS[n].build(sources[n]) for n in ("company", "funding_rounds")}
    fact = f.company_events(sources, dims).where("milestones_id IS NOT NULL")
    keys = d.INVESTMENT_DIMENSIONS["milestones"].build(sources["milestones"])
    when = F.col("milestone_at").cast("timestamp_ntz").cast("string")
    wanted = keys.join(sources["milestones"], F.col("milestone_nk") == F.col("milestone_id")).select("milestones_id", when, when.cast("date").cast("string"))
    found = fact.select("milestones_id", *[F.col(c).cast("string") for c in ("event_datetime", "event_date")])
    assert rows(found) == sorted(rows(wanted) * 2, key=lambda r: tuple((x is not None, str(x)) for x in r))  # b has two offices
    assert len(rows(wanted)) == 4
    assert "made_of" not in fact.columns


def test_a_text_with_a_date_and_no_moment_keeps_its_date(spark):
    sources = events(spark)
    sources["funds"] = sources["funds"].withColumn("funded_at", F.lit("2020-01-03 noon"))
    sources["ipos"] = sources["ipos"].withColumn("public_at", F.lit("2020-01-02 23:59:59").cast("timestamp"))
    dims = {n: d.INVESTMENT_DIMENSIONS[n].build(sources[n]) for n in ("company", "funding_rounds")}
    fact = f.company_events(sources, dims)
    when = [F.col(c).cast("string") for c in ("event_datetime", "event_date")]
    assert rows(fact.where("funds_id IS NOT NULL").select(*when)) == [(None, "2020-01-03")]
    assert rows(fact.where("ipos_id IS NOT NULL").select(*when)) == [("2020-01-02 23:59:59", "2020-01-02")]


def test_investments_are_hashed_after_their_join(spark):
    sources = events(spark)
    rounds = d.INVESTMENT_DIMENSIONS["funding_rounds"].build(sources["funding_rounds"])
    found = d.investments_dimension(sources["investments"], rounds)
    plan = optimized(found)
    assert plan.index("AS investments_id") < plan.index("Join")
    (key,) = [r[0] for r in rounds.select("funding_rounds_id").collect()]
    assert rows(found, "investment_nk", "funding_rounds_id") == [(1, key), (2, None)]


def test_lines_meet_their_book_before_the_order(spark):
    def table(columns):
        return spark.createDataFrame([], columns)

    sources = {
        "cust_order": table("order_id long, order_date timestamp, customer_id long, shipping_method_id int, dest_address_id int"),
        "order_history": table("order_id long, status_id int, status_date timestamp"),
        "order_status": table("status_id int, status_value string"),
        "customer_address": table("customer_id long, address_id int, status_id int"),
        "address_status": table("status_id int, address_status string"),
        "shipping_method": table("method_id int, method_name string, cost double"),
        "order_line": table("line_id long, order_id long, book_id long, price double"),
        "customer": table("customer_id long"), "address": table("address_id int"), "book": table("book_id long"),
    }
    plan = f.order_lines(sources, table("date_day date, sk_date_id string"), table("time_actual string, time_id int"))
    analyzed = plan._jdf.queryExecution().analyzed().toString().split("\n")
    last = next(line for line in analyzed if "Join" in line)
    assert "nk_order_id" in last and "book" not in last


def test_products_are_dealt_out_before_they_multiply(spark):
    products = spark.range(3).select(F.col("id").alias("product_id")).coalesce(1)
    stock = weekly_stock(products, spark, [2021])
    assert stock.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
    assert stock.count() == 3 * 52


def test_a_table_outside_every_circle_is_read_once(spark, monkeypatch):
    read, referring = Counter(), q._referring

    def counted(children, reference, parents):
        read[reference.child] += 1
        return referring(children, reference, parents)

    monkeypatch.setattr(q, "_referring", counted)
    people = spark.createDataFrame([(i, i - 1) for i in range(1, 7)], "id int, boss int")
    notes = spark.createDataFrame([(i * 10, i) for i in range(1, 7)], "note int, person int")
    marks = spark.createDataFrame([(i, i * 10) for i in range(1, 7)], "mark int, note int")
    done = q.cascade_graph(
        {"marks": marks, "notes": notes, "people": people}, {"people": ["id"], "notes": ["note"], "marks": ["mark"]},
        [q.Reference("marks", ("note",), "notes", ("note",)), q.Reference("people", ("boss",), "people", ("id",)),
         q.Reference("notes", ("person",), "people", ("id",))],
        {"people": people.where("id = 3").select("id"), "notes": notes.where("note = 10").select("note")},
    )
    assert rows(done.gone["people"]) == [(3,), (4,), (5,), (6,)]
    assert rows(done.gone["notes"]) == [(10,), (30,), (40,), (50,), (60,)]
    assert rows(done.left["marks"], "mark") == [(2,)]
    assert read["notes"] == 1 and read["marks"] == 1


def test_circles_come_parents_first():
    def ref(child, parent):
        return q.Reference(child, ("x",), parent, ("y",))

    graph = [ref("c", "b"), ref("b", "a"), ref("a", "b"), ref("d", "c"), ref("a", "top")]
    found = q._circles(["d", "c", "b", "a", "top", "alone"], graph)
    assert [sorted(c) for c in found if c != ["alone"]] == [["top"], ["a", "b"], ["c"], ["d"]]


def test_postings_move_texts_and_not_their_words(spark):
    placed = spark.createDataFrame([(1, "a b a", 0)], "doc long, text string, block long")
    plan = textindex._posted(placed, 4)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(block" in plan and "hashpartitioning(term" not in plan


def test_long_texts_make_smaller_blocks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(textindex, "_TASK_CHARS", 200)
    target = str(tmp_path / "index")
    docs = spark.createDataFrame([(i, "word " * 30 + f"only{i}") for i in range(20)], "doc long, text string")
    assert textindex.add(target, docs, "doc", "text") == 20
    (segment,) = textindex.segments(spark, target)
    blocks = spark.read.parquet(f"{target}/segments/{segment}/docs").select("block").distinct().count()
    assert blocks > 3
    asked = spark.createDataFrame([(1, "only7"), (2, "word")], "id int, text string")
    found = textindex.search(spark, target, asked, "id", "text", 2)
    assert rows(found, "query", "doc", "place") == [(1, 7, 1), (2, 0, 1), (2, 1, 2)]
