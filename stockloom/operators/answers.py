"""Answer tables of questions about a plan.

Questions with the same intent and the same named ids have the same answer, so an answer is made once
per different request (`answer_key`) and questions refer to it. An answer of any length is a set of rows
(answer_key, place, section): place 0 opens it, the sections follow in order of their places. No answer is
ever put together in one string, so none has a longest length. The text of a record is made once, and a
request without ids takes every record, without pairing questions and records.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockloom.functions import text as tx
from stockloom.operators.ordered import carry_last, ordered_chunks, row_numbers
from stockloom.session import settle

ID_LISTS = ["transfer_id", "manufacturing_id", "product_id", "store_id"]


def has_ids(*names: str) -> Column:
    return sum((F.size(n) for n in names), F.lit(0)) > 0


def _with_parameters(questions: DataFrame) -> DataFrame:
    lowered = questions.withColumn("_lower", F.lower("text"))
    joined = lowered.withColumn("_joined", tx.joined_ids(F.col("_lower")))
    ids = tx.named_ids(F.col("_joined"))
    return joined.withColumns({**ids, "is_all": tx.contains_any(F.col("_lower"), tx.ALL_WORDS)}).drop("_joined")


def parameters(questions: DataFrame) -> DataFrame:
    """Add the four id lists and `is_all`."""
    return _with_parameters(questions).drop("_lower")


def classify(questions: DataFrame, strict: bool = False) -> DataFrame:
    """Add parameters and `intent`: greeting, else keywords, else what the named ids suggest."""
    known = _with_parameters(questions).withColumn("_words", tx.keyword_intent(F.col("_lower")))
    rescued = (
        F.when(has_ids("store_id", "transfer_id"), "explain_transfer")
        .when(has_ids("manufacturing_id"), "explain_manufacturing")
        .when(has_ids("product_id"), "explain_transfer")
        .otherwise("out_of_scope")
    )
    intent = (
        F.when(tx.is_greeting(F.col("_lower"), strict), "greeting")
        .when(F.col("_words") == "out_of_scope", rescued)
        .otherwise(F.col("_words"))
    )
    return known.withColumn("intent", intent).drop("_words", "_lower")


def in_scope(intent: Column) -> Column:
    return ~intent.isin("out_of_scope", "greeting")


def understood(questions: DataFrame, strict: bool = False) -> DataFrame:
    """Questions without their text, classified, with carried intents.

    A short question takes long to classify, so they are dealt out first: each is classified once, by as many tasks as
    there are ranges, not by as many as a small file has parts, and not again for the bounds of the ranges.
    """
    spread = questions.sparkSession.conf.get("spark.sql.shuffle.partitions")
    return carry_over(settle(classify(_in_order(questions, int(spread)), strict).drop("text")), chunked=True)


def _in_order(questions: DataFrame, spread: int | None = None) -> DataFrame:
    # Ranges of rows, not of turn numbers: a conversation with most of the turns is cut like any other.
    return ordered_chunks(questions, ["conv_id", "turn"], spread)


def carry_over(classified: DataFrame, chunked: bool = False) -> DataFrame:
    """A follow-up that asks for everything takes the last in-scope intent of its conversation.

    Ids already decide the intent in `classify`, so carrying never changes which intent is the last one
    and a single ordered scan is exact. `chunked`: the rows come in ranges, with their `chunk`.
    """
    chunked = classified if chunked else _in_order(classified)
    last = F.when(in_scope(F.col("intent")), F.col("intent"))
    scanned = carry_last(chunked, ["conv_id"], ["turn"], last, "_last").drop("chunk")
    follows = (F.col("intent") == "out_of_scope") & F.col("_last").isNotNull() & (F.col("is_all") | has_ids(*ID_LISTS))
    return scanned.withColumn("intent", F.when(follows, F.col("_last")).otherwise(F.col("intent"))).drop("_last")


def display_label(intent: Column) -> Column:
    """The label shown for an intent; an intent without one is shown as it is."""
    pairs = [F.lit(x) for item in tx.INTENT_LABELS.items() for x in item]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), intent), intent)


def _marked(mark: str, ids: str) -> Column:
    return F.transform(ids, lambda x: F.concat(F.lit(f"{mark}:"), F.lower(x)))


def requests(answered: DataFrame) -> DataFrame:
    """Add `tokens` (what the answer is filtered by), `answer_key`, the shown label and the filter flag."""
    tokens = (
        F.when(
            F.col("intent") == "explain_transfer",
            F.concat(_marked("t", "transfer_id"), _marked("p", "product_id"), _marked("s", "store_id")),
        )
        .when(F.col("intent") == "explain_manufacturing", F.concat(_marked("m", "manufacturing_id"), _marked("p", "product_id")))
        .otherwise(F.array().cast("array<string>"))
    )
    topic = F.when(F.col("intent").isin("scenario_summary", "impact_analysis"), "scenario").otherwise(F.col("intent"))
    return answered.withColumns(
        {
            "label": display_label(F.col("intent")),
            "filter_applied": in_scope(F.col("intent")) & has_ids(*ID_LISTS),
            "tokens": F.array_sort(F.array_distinct(tokens)),
        }
    ).withColumn("answer_key", F.concat_ws("|", topic, F.array_join("tokens", ",")))


def _or_na(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit("N/A"))


def _count_text(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit(0)).cast("string")


def _lines(*parts: Column | str) -> Column:
    return F.concat_ws("\n", *[F.lit(p) if isinstance(p, str) else p for p in parts])


def _row(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"| {name} | "), value, F.lit(" |"))


def transfer_sections(records: DataFrame) -> DataFrame:
    """(position, tokens, section): the text of each transfer and the ids it is found by."""
    cost = {c: tx.dollars(F.col(f"cost_impact.{c}")) for c in (
        "transport_cost", "holding_cost_change", "stockout_penalty_avoided", "net_cost_change")}
    section = _lines(
        "---",
        F.concat(F.lit("**"), _or_na("transfer_id"), F.lit(" — "), _or_na("product_id"), F.lit("**  ")),
        F.concat(F.lit("Route: "), _or_na("from_store"), F.lit(" → "), _or_na("to_store"), F.lit("  ")),
        F.concat(F.lit("Quantity: **"), _count_text("quantity"), F.lit(" units**  ")),
        F.concat(F.lit("Reasons: "), tx.spaced(F.coalesce("reason_codes", F.array().cast("array<string>"))), F.lit("  ")),
        "",
        "| Metric | Value |",
        "|--------|-------|",
        _row("Transport cost", cost["transport_cost"]),
        _row("Holding cost change", cost["holding_cost_change"]),
        _row("Stockout penalty avoided", cost["stockout_penalty_avoided"]),
        _row("**Net cost change**", F.concat(F.lit("**"), cost["net_cost_change"], F.lit("**"))),
        _row("Stockout before", F.concat(_count_text("service_level_impact.baseline_stockout_units"), F.lit(" units"))),
        _row("Stockout after", F.concat(_count_text("service_level_impact.post_transfer_stockout_units"), F.lit(" units"))),
        _row("Stockout reduction", tx.percent(F.col("service_level_impact.stockout_reduction_pct"))),
    )
    found_by = F.array(
        F.concat(F.lit("t:"), F.lower("transfer_id")), F.concat(F.lit("p:"), F.lower("product_id")),
        F.concat(F.lit("s:"), F.lower("from_store")), F.concat(F.lit("s:"), F.lower("to_store")),
    )
    return records.select("scenario", "position", F.array_distinct(F.array_compact(found_by)).alias("tokens"), section.alias("section"))


def manufacturing_sections(records: DataFrame) -> DataFrame:
    cost = {c: tx.dollars(F.col(f"cost_impact.{c}")) for c in (
        "manufacturing_cost", "distribution_cost", "total_manufacturing_cost")}
    section = _lines(
        "---",
        F.concat(F.lit("**"), _or_na("manufacturing_id"), F.lit(" — "), _or_na("product_id"), F.lit("**  ")),
        F.concat(F.lit("Quantity to manufacture: **"), _count_text("manufacture_quantity"), F.lit(" units**  ")),
        F.concat(F.lit("Reasons: "), tx.spaced(F.coalesce("reason_codes", F.array().cast("array<string>"))), F.lit("  ")),
        "",
        "| Metric | Value |",
        "|--------|-------|",
        _row("Manufacturing cost", cost["manufacturing_cost"]),
        _row("Distribution cost", cost["distribution_cost"]),
        _row("**Total cost**", F.concat(F.lit("**"), cost["total_manufacturing_cost"], F.lit("**"))),
    )
    found_by = F.array(F.concat(F.lit("m:"), F.lower("manufacturing_id")), F.concat(F.lit("p:"), F.lower("product_id")))
    return records.select("scenario", "position", F.array_distinct(F.array_compact(found_by)).alias("tokens"), section.alias("section"))


def _requested(asked: DataFrame, intent: str) -> DataFrame:
    return asked.where(F.col("intent") == intent).select("answer_key", "tokens").distinct()


#: Positions in one entry of a posting list.
POSTING_BLOCK = 4096
BLOCK = ["scenario", "token", "block"]
ANY = "*"


def scenario_name(column: str = "scenario") -> Column:
    return F.coalesce(F.col(column), F.lit("Unknown"))


def scenario_names(*tables: DataFrame) -> DataFrame:
    """(scenario): the different scenarios the tables have records of."""
    return reduce(DataFrame.unionByName, [t.select(scenario_name().alias("scenario")) for t in tables]).distinct()


def _placed(sections: DataFrame, *kept: str) -> DataFrame:
    """(scenario, token, block, position, tokens, records): a row per place and id it is found by, and one under ANY. `tokens`
    are all of them; records that share a place are found together. `records` has the columns `kept` of each, if any."""
    records = sections.where("position IS NOT NULL").select(scenario_name().alias("scenario"), "position", "tokens", *kept)
    found = records.groupBy("scenario", "position").agg(
        F.array_distinct(F.flatten(F.collect_list(F.array_append("tokens", F.lit(ANY))))).alias("tokens"),
        *([F.collect_list(F.struct(*kept)).alias("records")] if kept else []),
    )
    block = F.floor(F.col("position") / POSTING_BLOCK)
    return found.select("scenario", F.explode("tokens").alias("token"), block.alias("block"), "position", "tokens", *(["records"] if kept else []))


def postings(sections: DataFrame) -> DataFrame:
    """(scenario, token, block, positions, found_by): an inverted index of the records, and ANY for all of them. `found_by`
    has all tokens of each position.

    A list is cut into blocks of positions, so an id that most records name is many rows of bounded size.
    """
    entries = F.array_sort(F.collect_list(F.struct("position", "tokens")))
    index = _placed(sections).groupBy("scenario", "token", "block").agg(entries.alias("_entries"))
    return index.select("scenario", "token", "block", F.col("_entries.position").alias("positions"), F.col("_entries.tokens").alias("found_by"))


def _sought(asked: DataFrame, blocks: DataFrame, intent: str) -> DataFrame:
    """(scenario, token, block, answer_key, earlier): the blocks each different request reads, token by token. `earlier` are
    the tokens of the request read before this one: what they find is not taken again."""
    tokens = F.when(F.size("tokens") == 0, F.array(F.lit(ANY))).otherwise(F.col("tokens"))
    each = _requested(asked, intent).select("answer_key", F.explode(tokens).alias("token"))
    wanted = each.groupBy("answer_key").agg(F.array_sort(F.collect_set("token")).alias("_all"))
    read = wanted.select("answer_key", "_all", F.posexplode("_all").alias("_n", "token"))
    earlier = F.when(F.col("_n") > 0, F.slice("_all", F.lit(1), F.col("_n")))
    return read.select("answer_key", "token", earlier.alias("earlier")).join(blocks.select("scenario", "token", "block").distinct(), "token")


def _dealt(entries: DataFrame) -> DataFrame:
    """Entries by block, in as many tasks as the session shuffles to: they are small, but not what they meet with, so they
    must not be put together by size."""
    return entries.repartition(int(entries.sparkSession.conf.get("spark.sql.shuffle.partitions")), *BLOCK)


def matched_blocks(asked: DataFrame, index: DataFrame, intent: str) -> DataFrame:
    """(scenario, answer_key, block, positions): the records each different request is about, as unions of posting lists.

    Each list of a request leaves out what its lists before have, told by the tokens of the records, so lists need not meet:
    only requests and the index are shuffled, and matches, of which there may be as many as requests times records, are
    neither shuffled nor listed one by one.
    """
    met = _dealt(index).join(_sought(asked, index, intent), BLOCK)
    fresh = F.transform(
        F.filter(F.arrays_zip("positions", "found_by"), lambda e: ~F.arrays_overlap(e["found_by"], F.col("earlier"))), lambda e: e["positions"])
    positions = F.when(F.col("earlier").isNull(), F.col("positions")).otherwise(fresh)
    return met.select("scenario", "answer_key", "block", positions.alias("positions")).where(F.size("positions") > 0)


def listed(blocks: DataFrame) -> DataFrame:
    """(scenario, answer_key, position): the matches one by one, for reading."""
    return blocks.select("scenario", "answer_key", F.explode("positions").alias("position"))


def matches(asked: DataFrame, sections: DataFrame, intent: str) -> DataFrame:
    """(scenario, answer_key, position): the records each different request is about, in every scenario."""
    return listed(matched_blocks(asked, settle(postings(sections)), intent))


def matched_texts(asked: DataFrame, sections: DataFrame, intent: str) -> DataFrame:
    """(scenario, answer_key, position, section): the matches with the texts of their records.

    The texts go to the blocks instead of the matches to the texts: every record meets the requests that read its block
    under one of its tokens, and a request takes it by the first. A record's matches come one after the other.
    """
    placed = _placed(sections, "section")
    read = settle(_sought(asked, settle(placed.select(*BLOCK).distinct()), intent))
    placed = placed.join(read.select("token").distinct(), "token", "left_semi")
    met = _dealt(placed).join(read, BLOCK)
    first = F.col("earlier").isNull() | ~F.arrays_overlap("tokens", "earlier")
    return met.where(first).select("scenario", "answer_key", "position", F.inline("records"))


def answer_headers(asked: DataFrame, blocks: DataFrame, intent: str, scenarios: DataFrame) -> DataFrame:
    """(scenario, answer_key, n_matches, header): the opening lines, or the message that nothing matches."""
    noun, nothing = {
        "explain_transfer": ("transfers", tx.NO_TRANSFERS),
        "explain_manufacturing": ("manufacturing actions", tx.NO_MANUFACTURING),
    }[intent]
    keys = ["scenario", "answer_key"]
    counts = blocks.groupBy(*keys).agg(F.sum(F.size("positions")).alias("n_matches"))
    # Every request is answered for every scenario, so this is as long as the answers are.
    all_keys = _requested(asked, intent).select("answer_key").join(scenarios, F.lit(True)).join(counts, keys, "left")
    n = F.coalesce("n_matches", F.lit(0).cast("bigint"))
    header = F.concat(
        F.lit("**Scenario:** "), F.col("scenario"), F.lit(f"  \n**Matching {noun}:** "), n.cast("string")
    )
    return all_keys.select(*keys, n.alias("n_matches"), F.when(n > 0, header).otherwise(nothing).alias("header"))


def record_answers(asked: DataFrame, sections: DataFrame, intent: str, scenarios: DataFrame) -> DataFrame:
    """(scenario, answer_key, place, section): the header at place 0, each matching record at its position plus one.
    `asked` and `sections` are read several times, so pass stored tables."""
    blocks = matched_blocks(asked, settle(postings(sections)), intent)
    headers = settle(answer_headers(asked, blocks, intent, scenarios))
    bodies = matched_texts(asked, sections, intent)
    return headers.select("scenario", "answer_key", F.lit(0).cast("bigint").alias("place"), F.col("header").alias("section")).unionByName(
        bodies.select("scenario", "answer_key", (F.col("position") + 1).cast("bigint").alias("place"), "section")
    )


def at_once(answers: DataFrame) -> DataFrame:
    """Answers that are one text, (scenario, answer_key, text), as rows with the single place 0."""
    return answers.select("scenario", "answer_key", F.lit(0).cast("bigint").alias("place"), F.col("text").alias("section"))


def scenario_answer(scenario: DataFrame) -> DataFrame:
    """(scenario, answer_key, text) comparing baseline and optimized; one row per scenario record."""
    def money(path: str) -> Column:
        return tx.dollars(F.col(path))

    text = _lines(
        F.concat(F.lit("**Scenario:** "), F.coalesce("scenario", F.lit("Unknown"))),
        "",
        "| | Baseline | Optimized |",
        "|---|---|---|",
        F.concat(F.lit("| Total cost | "), money("baseline.total_cost"), F.lit(" | "), money("optimized.total_cost"), F.lit(" |")),
        F.concat(
            F.lit("| Total stockouts | "), _count_text("baseline.total_stockouts"), F.lit(" units | "),
            _count_text("optimized.total_stockouts"), F.lit(" units |"),
        ),
        "",
        "**Improvement after optimization:**",
        "",
        "| Metric | Value |",
        "|--------|-------|",
        _row("Cost change", money("delta.cost_change")),
        _row("Stockout units reduced", _count_text("delta.stockout_reduction_units")),
        _row("Stockout reduction", tx.percent(F.col("delta.stockout_reduction_pct"))),
    )
    return scenario.select(scenario_name().alias("scenario"), F.lit("scenario|").alias("answer_key"), text.alias("text"))


def entities(transfers: DataFrame, manufacturing: DataFrame) -> DataFrame:
    """(scenario, kind, id): the different products and stores named in the results."""
    name = scenario_name().alias("scenario")
    products = transfers.select(name, "product_id").unionByName(manufacturing.select(name, "product_id"))
    stores = transfers.select(name, F.explode(F.array("from_store", "to_store")).alias("id"))
    named = products.select("scenario", F.lit("product").alias("kind"), F.col("product_id").alias("id")).unionByName(
        stores.select("scenario", F.lit("store").alias("kind"), "id")
    )
    return named.where("id IS NOT NULL").distinct()


def entity_answer(named: DataFrame, scenarios: DataFrame) -> DataFrame:
    """(scenario, answer_key, place, section): products, then stores, one row per id under a heading each."""
    numbered = row_numbers(named, ["scenario", "kind", "id"], "_n")  # products come before stores
    counted = named.groupBy("scenario").agg(
        F.count_if(F.col("kind") == "product").alias("n_products"), F.count_if(F.col("kind") == "store").alias("n_stores")
    )
    known = scenarios.join(counted, "scenario", "left").na.fill(0, ["n_products", "n_stores"])
    none = lambda n: F.when(F.col(n) == 0, F.lit("\n- None")).otherwise("")
    top = F.concat(_lines(
        F.concat(F.lit("**Scenario:** "), F.col("scenario")), "", "**Products involved/at risk**:"
    ), none("n_products"))
    middle = F.concat(F.lit("\n**Stores involved**:"), none("n_stores"))
    headings = known.select("scenario", F.explode(F.array(
        F.struct(F.lit(0).cast("bigint").alias("place"), top.alias("section")),
        F.struct((F.col("n_products") + 1).alias("place"), middle.alias("section")),
    )).alias("_h")).select("scenario", "_h.*")
    begins = numbered.groupBy("scenario").agg((F.min("_n") - 1).alias("_before"))
    place = F.col("_n") - F.col("_before") + F.when(F.col("kind") == "store", 1).otherwise(0)
    items = numbered.join(begins, "scenario").select("scenario", place.alias("place"), F.concat(F.lit("- "), "id").alias("section"))
    return headings.unionByName(items).select("scenario", F.lit("list_entities|").alias("answer_key"), "place", "section")


def result_counts(transfers: DataFrame, manufacturing: DataFrame) -> DataFrame:
    """(scenario, n_transfers, n_manufacturing, n_products): transfers, production rows and different products in either."""
    name = scenario_name().alias("scenario")
    moved = transfers.select(name, "product_id", F.lit(1).alias("_t"), F.lit(0).alias("_m"))
    made = manufacturing.select(name, "product_id", F.lit(0).alias("_t"), F.lit(1).alias("_m"))
    each = moved.unionByName(made).groupBy("scenario", "product_id").agg(F.sum("_t").alias("_t"), F.sum("_m").alias("_m"))
    return each.groupBy("scenario").agg(
        F.sum("_t").alias("n_transfers"), F.sum("_m").alias("n_manufacturing"), F.count("product_id").alias("n_products")
    )


def count_answer(counts: DataFrame, scenarios: DataFrame) -> DataFrame:
    def item(name: str, column: str) -> Column:
        return F.concat(F.lit(f"- {name}: **"), F.col(column).cast("string"), F.lit("**"))

    text = _lines(
        F.concat(F.lit("**Scenario:** "), F.col("scenario")), "",
        "**Overall Summary Metrics:**",
        item("Total Transfer Recommendations", "n_transfers"),
        item("Total Manufacturing Decisions", "n_manufacturing"),
        item("Unique Products Affected", "n_products"),
    )
    known = scenarios.join(counts, "scenario", "left").na.fill(0)
    return known.select("scenario", F.lit("total_counts|").alias("answer_key"), text.alias("text"))


def fixed_replies(any_frame: DataFrame) -> DataFrame:
    """(scenario, answer_key, text) for greetings and questions out of scope, the same for every scenario."""
    rows = [(None, "greeting|", tx.GREETING_REPLY), (None, "out_of_scope|", tx.OUT_OF_SCOPE_REPLY)]
    return any_frame.sparkSession.createDataFrame(rows, "scenario string, answer_key string, text string")


def needs_no_rewriting(answer_key: Column, section: Column) -> Column:
    """Rows of answers that are shown as they are: lists, counts and empty results."""
    listed = answer_key.isin("list_entities|", "total_counts|")
    return listed | F.coalesce(section.isin(tx.NO_TRANSFERS, tx.NO_MANUFACTURING), F.lit(False))


def intent_distribution(answered: DataFrame) -> DataFrame:
    return answered.groupBy("intent").agg(F.count("*").alias("n_questions"))


def missing_fields(records: DataFrame, required: list[str]) -> DataFrame:
    """Records with the names of required fields they lack (`missing`); complete records are left out."""
    lacking = F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in required]))
    return records.withColumn("missing", lacking).where(F.size("missing") > 0)
