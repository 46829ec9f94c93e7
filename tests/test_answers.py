"""Question rules and answer texts on invented records."""

import json

import pytest
from pyspark.sql import functions as F

from stockloom import schemas
from stockloom.functions import text as tx
from stockloom.operators import answers as an
from stockloom.plans.answering import answer
from stockloom.sources import sinks, tables

SL = (12, 3, 0.75)
TRANSFERS = [
    ("High", 0, "T001", "store_1", "store_2", "product_7", 15, ["high_delay_probability", "excess_inventory_at_source"],
     (1234.5, -2.5, 99.0, 1133.0), SL),
    ("High", 1, "T002", "store_3", "store_1", "product_9", 4, ["rebalance_inventory"], None, None),
]
MADE = [("High", 0, "M001", "product_7", 30, ["manufacture_to_avoid_stockout"], (2.5, 0.0, 2.5))]


@pytest.fixture(scope="module")
def records(spark):
    transfer = "scenario string, position bigint, " + ", ".join(
        f"{f.name} {f.dataType.simpleString()}" for f in schemas.TRANSFER_RECORD.fields)
    made = "scenario string, position bigint, " + ", ".join(
        f"{f.name} {f.dataType.simpleString()}" for f in schemas.MANUFACTURING_RECORD.fields)
    scenario = spark.createDataFrame([("High", (1000.0, 50), (800.5, 5), (-199.5, 45, 0.9))], schemas.SCENARIO_DOCUMENT)
    return spark.createDataFrame(TRANSFERS, transfer), spark.createDataFrame(MADE, made), scenario


def ask(spark, *texts):
    return spark.createDataFrame([(1, i, t) for i, t in enumerate(texts)], "conv_id bigint, turn bigint, text string")


@pytest.mark.parametrize("text, intent", [
    ("why should I transfer?", "explain_transfer"),
    ("what are my recommendations?", "explain_transfer"),
    ("why was product manufactured?", "explain_manufacturing"),
    ("how did the scenario perform?", "scenario_summary"),
    ("what was the cost impact?", "impact_analysis"),
    ("how many recommendations in total do you have?", "total_counts"),
    ("what is the weather today?", "out_of_scope"),
    ("  Hello there", "greeting"), ("your stores", "greeting"), ("\tsupply", "greeting"),
    ("tell me about Store 7", "explain_transfer"), ("and m_123", "explain_manufacturing"),
    ("and product 9", "explain_transfer"), ("t1234", "explain_transfer"), ("t12", "out_of_scope"), ("", "out_of_scope"),
])
def test_intents(spark, text, intent):
    assert an.classify(ask(spark, text)).first()["intent"] == intent


def test_strict_greeting_wants_a_whole_word(spark):
    got = [r["intent"] for r in an.classify(ask(spark, "your stores", "yo!"), strict=True).orderBy("turn").collect()]
    assert got == ["out_of_scope", "greeting"]


def test_parameters(spark):
    row = an.parameters(ask(spark, "List T001, t_002 and M003 for Product  12 at store 5, store_6")).first()
    assert (row["transfer_id"], row["manufacturing_id"]) == (["T001", "T002"], ["M003"])
    assert (row["product_id"], row["store_id"], row["is_all"]) == (["product_12"], ["store_5", "store_6"], True)


def test_carry_over(spark):
    turns = ask(spark, "show all", "what was the cost impact?", "hello", "show all", "nice weather", "production?", "everything")
    got = [r["intent"] for r in an.carry_over(an.classify(turns)).orderBy("turn").collect()]
    assert got == ["out_of_scope", "impact_analysis", "greeting", "impact_analysis", "out_of_scope", "explain_manufacturing", "explain_manufacturing"]


def test_labels(spark):
    got = [r[0] for r in ask(spark, "greeting", "total_counts").orderBy("turn").select(an.display_label(F.col("text"))).collect()]
    assert got == ["greeting", "Summary Metrics"]


FIRST = """---
**T001 — product_7**  
Route: store_1 → store_2  
Quantity: **15 units**  
Reasons: high delay probability, excess inventory at source  

| Metric | Value |
|--------|-------|
| Transport cost | $1,234 |
| Holding cost change | $-2 |
| Stockout penalty avoided | $99 |
| **Net cost change** | **$1,133** |
| Stockout before | 12 units |
| Stockout after | 3 units |
| Stockout reduction | 75.0% |"""
SECOND = """---
**T002 — product_9**  
Route: store_3 → store_1  
Quantity: **4 units**  
Reasons: rebalance inventory  

| Metric | Value |
|--------|-------|
| Transport cost | $0 |
| Holding cost change | $0 |
| Stockout penalty avoided | $0 |
| **Net cost change** | **$0** |
| Stockout before | 0 units |
| Stockout after | 0 units |
| Stockout reduction | 0.0% |"""


def shown(made):
    """Each answer as the text its rows make when read in order."""
    texts = {}
    for r in made.rows.orderBy("place").collect():
        texts.setdefault(r["answer_key"], []).append(r)
    return {k: ("\n\n" if k.startswith("explain") else "\n").join(r["section"] for r in v) for k, v in texts.items()}, {
        k: {r["as_is"] for r in v} for k, v in texts.items()
    }


def test_answers(spark, records):
    texts = ["why transfer", "transfer for store 3", "transfer t_001 and product 9", "transfer of store 99", "manufacture",
             "manufacture product 8", "scenario", "how many", "hello", "weather", "transfer for STORE_3 and product 9"]
    made = answer(ask(spark, *texts), *records)
    by_key, as_is = shown(made)
    keys = [r["answer_key"] for r in made.questions.orderBy("turn").collect()]
    got = [by_key[k] for k in keys]
    head = "**Scenario:** High  \n**Matching transfers:** {}\n\n"
    assert got[0] == got[2] == head.format(2) + FIRST + "\n\n" + SECOND
    assert got[1] == got[10] == head.format(1) + SECOND
    assert got[3].startswith("No transfers match")
    assert got[4] == (
        "**Scenario:** High  \n**Matching manufacturing actions:** 1\n\n---\n**M001 — product_7**  \n"
        "Quantity to manufacture: **30 units**  \nReasons: manufacture to avoid stockout  \n\n| Metric | Value |\n|--------|-------|\n"
        "| Manufacturing cost | $2 |\n| Distribution cost | $0 |\n| **Total cost** | **$2** |")
    assert got[5].startswith("No manufacturing actions match")
    assert "| Total cost | $1,000 | $800 |\n| Total stockouts | 50 units | 5 units |" in got[6]
    assert got[6].endswith("| Cost change | $-200 |\n| Stockout units reduced | 45 |\n| Stockout reduction | 90.0% |")
    assert got[7].endswith("- Total Transfer Recommendations: **2**\n- Total Manufacturing Decisions: **1**\n- Unique Products Affected: **2**")
    assert got[8].startswith("Hello. I am") and got[9].startswith("This query appears")
    assert [as_is[k] for k in keys] == [{x} for x in (False, False, False, True, False, True, False, True, False, False, False)]
    assert as_is["list_entities|"] == {True}
    assert by_key["list_entities|"] == (
        "**Scenario:** High\n\n**Products involved/at risk**:\n- product_7\n- product_9\n\n**Stores involved**:\n- store_1\n- store_2\n- store_3")
    flags = [r["filter_applied"] for r in made.questions.orderBy("turn").collect()]
    assert flags == [False, True, True, True, False, True, False, False, False, False, True]


def test_answers_have_no_longest_length(spark, records):
    """A product with 1,500 transfers, asked for by itself, with a second id, and with everything else."""
    transfers, manufacturing, scenario = records
    many = spark.range(1500).select(
        F.lit("High").alias("scenario"), F.col("id").alias("position"), F.format_string("T%03d", F.col("id") + 1).alias("transfer_id"),
        F.format_string("store_%d", F.col("id") % 1200).alias("from_store"), F.lit("store_9999").alias("to_store"),
        F.lit("product_7").alias("product_id"), F.col("id").alias("quantity"), *[F.lit(None).cast(f.dataType).alias(f.name) for f in transfers.schema.fields[7:]])
    made = answer(ask(spark, "transfers for product 7", "transfers for product 7 and store 3", "explain all transfers", "explain T1234"), many, manufacturing, scenario)
    keys = [r["answer_key"] for r in made.questions.orderBy("turn").collect()]
    found = {k: made.rows.where(F.col("answer_key") == k).orderBy("place").collect() for k in keys}
    assert [len(found[k]) for k in keys] == [1501, 1501, 1501, 2]
    assert [r["place"] for r in found[keys[0]]] == list(range(1501))
    assert found[keys[0]][0]["section"].endswith("**Matching transfers:** 1500")
    assert "**T1234 — product_7**" in found[keys[3]][1]["section"]
    assert made.rows.where("answer_key = 'list_entities|'").count() == 2 + 1 + 1201


def test_no_results(spark, records):
    transfers, manufacturing, scenario = records
    texts, _ = shown(answer(ask(spark, "why transfer"), transfers.limit(0), manufacturing.limit(0), scenario))
    assert texts["explain_transfer|"].startswith("No transfers match")
    assert texts["list_entities|"].endswith("- None\n\n**Stores involved**:\n- None")


def test_required_fields(spark, records):
    got = an.missing_fields(records[0], schemas.REQUIRED["transfer"]).collect()
    assert [r["transfer_id"] for r in got] == ["T002"]
    assert got[0]["missing"][0] == "cost_impact" and len(got[0]["missing"]) == 4


def test_documents_round_trip(spark, records, tmp_path):
    rows = records[0].drop("scenario")
    sinks.write_document(rows, str(tmp_path / "one"), "transfers", "High")
    whole = "".join(p.read_text() for p in sorted((tmp_path / "one").glob("part-*")))
    parsed = json.loads(whole)
    assert (parsed["scenario"], [t["transfer_id"] for t in parsed["transfers"]]) == ("High", ["T001", "T002"])
    back = tables.read_document(spark, str(tmp_path / "one"), schemas.TRANSFER_RECORD).orderBy("transfer_id").collect()
    assert [(r["scenario"], r["transfer_id"], r["quantity"]) for r in back] == [("High", "T001", 15), ("High", "T002", 4)]
    assert back[1]["cost_impact"] is None
    (tmp_path / "file.json").write_text(whole)
    again = tables.read_transfers(spark, str(tmp_path / "file.json")).orderBy("position").collect()
    assert [(r["position"], r["transfer_id"]) for r in again] == [(0, "T001"), (1, "T002")]
    sinks.write_document(rows.limit(0), str(tmp_path / "none"), "transfers", "High")
    assert json.loads("".join(p.read_text() for p in sorted((tmp_path / "none").glob("part-*"))))["transfers"] == []
    assert tables.read_document(spark, str(tmp_path / "none"), schemas.TRANSFER_RECORD).count() == 0


def test_broken_records_are_kept_and_named(spark, tmp_path):
    (tmp_path / "r.json").write_text('{"product_id": "p", "manufacture_quantity": 3, "reason_codes": []}\n{"product_id": \n[1]\n{"product_id": "q", "manufacture_quantity": "many"}\n')
    good, bad = tables.read_records(spark, str(tmp_path / "r.json"), schemas.MANUFACTURING_RECORD)
    assert [r["product_id"] for r in good.collect()] == ["p"]
    assert sorted(r["record"] for r in bad.collect()) == ['[1]', '{"product_id": ', '{"product_id": "q", "manufacture_quantity": "many"}']


def test_every_scenario_is_answered(spark, records):
    """A second scenario gets its own headers, matches, lists and counts; a nameless one is called Unknown."""
    transfers, manufacturing, scenario = records
    second = transfers.where("transfer_id = 'T002'").withColumns({"scenario": F.lit("Low"), "position": F.lit(0).cast("bigint")})
    third = scenario.withColumn("scenario", F.lit(None).cast("string"))
    made = answer(ask(spark, "transfers for product 9", "why transfer", "explain T001"), transfers.unionByName(second), manufacturing,
                  scenario.unionByName(scenario.withColumn("scenario", F.lit("Low"))).unionByName(third))
    rows = {}
    for r in made.rows.orderBy("place").collect():
        rows.setdefault((r["scenario"], r["answer_key"]), []).append(r["section"])
    by_product = "explain_transfer|p:product_9"
    assert len(rows["High", by_product]) == len(rows["Low", by_product]) == 2
    assert rows["Low", by_product][0].startswith("**Scenario:** Low") and rows["Unknown", by_product] == [tx.NO_TRANSFERS]
    assert len(rows["High", "explain_transfer|"]) == 3 and len(rows["Low", "explain_transfer|"]) == 2
    assert rows["Low", "explain_transfer|t:t001"] == [tx.NO_TRANSFERS]
    assert {s for s, k in rows if k == "scenario|"} == {"High", "Low", "Unknown"}
    assert rows["Low", "list_entities|"][1:] == ["- product_9", "\n**Stores involved**:", "- store_1", "- store_3"]
    assert "Total Transfer Recommendations: **1**" in rows["Low", "total_counts|"][0]
    assert "Total Manufacturing Decisions: **0**" in rows["Unknown", "total_counts|"][0]
    assert [s for s, k in rows if k == "greeting|"] == [None]


def test_posting_lists_are_cut_and_united(spark, monkeypatch):
    """An id most records name is many blocks of bounded length; a request of several ids has each record once."""
    monkeypatch.setattr(an, "POSTING_BLOCK", 10)
    sections = spark.range(95).select(
        F.lit("A").alias("scenario"), F.col("id").alias("position"),
        F.array_compact(F.array(F.lit("p:hot"), F.when(F.col("id") % 7 == 0, F.lit("s:few")), F.concat(F.lit("t:"), F.col("id")))).alias("tokens"))
    index = an.postings(sections)
    assert index.where("token = 'p:hot'").count() == 10 and index.agg(F.max(F.size("positions"))).first()[0] == 10
    asked = spark.createDataFrame(
        [("k0", "x", ["p:hot"]), ("k0", "x", ["p:hot"]), ("k1", "x", ["p:hot", "s:few"]), ("k2", "x", []), ("k3", "x", ["s:few", "t:1"]), ("k4", "x", ["none"])],
        "answer_key string, intent string, tokens array<string>")
    blocks = an.matched_blocks(asked, index, "x")
    assert blocks.agg(F.max(F.size("positions"))).first()[0] == 10
    got = {}
    for r in an.listed(blocks).collect():
        got.setdefault(r["answer_key"], []).append(r["position"])
    everything, few = list(range(95)), [i for i in range(95) if i % 7 == 0]
    assert {k: sorted(v) for k, v in got.items()} == {"k0": everything, "k1": everything, "k2": everything, "k3": sorted([1, *few])}


def above_the_join(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Join" in plan
    return plan[:plan.index("Join")]


def test_matches_are_not_shuffled(spark, monkeypatch):
    """There may be as many as requests times records, so only requests, records and their index move; each match once."""
    monkeypatch.setattr(an, "POSTING_BLOCK", 3)
    monkeypatch.setattr(an, "settle", lambda df: df)
    rows = [("A", i, ["p:1", f"s:{i % 2}", "s:7"], f"text {i}") for i in range(8)]
    rows += [("A", 2, ["p:2"], "other 2"), ("A", None, ["p:1"], "nowhere"), (None, 0, ["p:2", "s:0"], "unknown"), ("A", 9, ["p:2"], None)]
    sections = spark.createDataFrame(rows, "scenario string, position bigint, tokens array<string>, section string")
    asked = spark.createDataFrame(
        [("both", "x", ["p:1", "p:2", "s:0", "s:7"]), ("both", "x", ["p:1", "p:2", "s:0", "s:7"]), ("all", "x", []), ("one", "x", ["s:1"]),
         ("pair", "x", ["s:0", "s:1"]), ("none", "x", ["p:9"]), ("other", "y", ["p:1"])], "answer_key string, intent string, tokens array<string>")
    blocks, texts = an.matched_blocks(asked, an.postings(sections), "x"), an.matched_texts(asked, sections, "x")
    assert "Exchange" not in above_the_join(blocks) and "Exchange" not in above_the_join(texts)
    known = [(s or "Unknown", p, set(t), x) for s, p, t, x in rows if p is not None]
    found_by = {}
    for s, p, t, _ in known:
        found_by.setdefault((s, p), set()).update(t)  # records of one place are found together
    want = {
        k: [(s, p, x) for s, p, _, x in known if not w or found_by[s, p] & set(w)]
        for k, i, w in map(tuple, asked.collect()) if i == "x"
    }
    named = an.scenario_names(sections)
    for key, hits in want.items():
        got = texts.where(F.col("answer_key") == key).select("scenario", "position", "section").collect()
        assert sorted(map(tuple, got), key=str) == sorted(hits, key=str)
        places = an.listed(blocks).where(F.col("answer_key") == key).select("scenario", "position").collect()
        assert sorted(map(tuple, places)) == sorted({h[:2] for h in hits})
        shown = an.record_answers(asked.withColumn("intent", F.regexp_replace("intent", "x", "explain_transfer")), sections, "explain_transfer", named)
        assert shown.where((F.col("answer_key") == key) & (F.col("place") > 0)).count() == len(hits)


def test_questions_are_classified_in_many_tasks(spark, monkeypatch):
    """A small file of many short questions is one part, but not one task of classification; results are as before."""
    texts = ["why transfer product 7", "show all", "good morning", "list everything", "m_123 please"]
    asked = spark.range(0, 400, 1, 1).select(
        (F.col("id") % 9).alias("conv_id"), F.col("id").alias("turn"), F.element_at(F.array(*map(F.lit, texts)), (F.col("id") % 5 + 1).cast("int")).alias("text"))
    seen, classify = [], an.classify
    monkeypatch.setattr(an, "classify", lambda q, strict=False: seen.append(q.select("chunk").distinct().count()) or classify(q, strict))
    got = an.understood(asked)
    assert seen == [int(spark.conf.get("spark.sql.shuffle.partitions"))] and "text" not in got.columns
    shown = ["conv_id", "turn", "intent"]
    assert sorted(map(tuple, got.select(shown).collect())) == sorted(map(tuple, an.carry_over(classify(asked)).select(shown).collect()))


def test_the_plan_of_all_answers_has_only_requests_and_records(spark, records):
    """What needs no request is stored first; the plan that writes the answers joins requests with records and reads the rest."""
    transfers, manufacturing, scenario = records
    costs = scenario.join(transfers.agg(F.count("*").alias("n")).join(manufacturing.agg(F.count("*").alias("m")))).drop("n", "m")  # behind joins, as in a run
    made = answer(ask(spark, "transfers for product 9", "list entities", "how many transfers"), transfers, manufacturing, costs)
    plan = made.rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 2 * 2 and "Window" not in plan  # per kind of record: its tokens asked for, and the requests
    keys = {r["answer_key"] for r in made.rows.select("answer_key").distinct().collect()}
    assert {"explain_transfer|p:product_9", "scenario|", "list_entities|", "total_counts|", "greeting|", "out_of_scope|"} <= keys
