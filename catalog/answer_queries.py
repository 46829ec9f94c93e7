"""Question classification and answer queries."""

from pyspark.sql import functions as F

from catalog.registry import query
from catalog.supply_queries import COSTS, SCENARIO, TO_COSTS, run
from catalog.views import QUESTIONS, with_views
from stockloom import schemas
from stockloom.functions import text as tx
from stockloom.operators import answers as an
from stockloom.plans.answering import answer_rows
from stockloom.session import settle
from stockloom.sources import domain_views as views


def _any(words: list[str]) -> str:
    return "(" + "|".join(words).replace("'", "''") + ")"


_groups = [
    ("total_counts", tx.COUNT_WORDS), ("explain_transfer", tx.TRANSFER_WORDS),
    ("explain_manufacturing", tx.MANUFACTURING_WORDS), ("scenario_summary", tx.SCENARIO_WORDS),
    ("impact_analysis", tx.IMPACT_WORDS),
]
CLASSIFIED = f"""
params_of AS (SELECT *, list_transform(regexp_extract_all(joined, '\\bt_?\\d{{3,}}\\b'), lambda x: upper(replace(x, '_', ''))) AS transfer_id,
  list_transform(regexp_extract_all(joined, '\\bm_?\\d{{3,}}\\b'), lambda x: upper(replace(x, '_', ''))) AS manufacturing_id,
  regexp_extract_all(joined, '\\bproduct_\\d+\\b') AS product_id, regexp_extract_all(joined, '\\bstore_\\d+\\b') AS store_id,
  regexp_matches(lower("text"), '{_any(tx.ALL_WORDS)}') AS is_all
  FROM (SELECT *, regexp_replace(lower("text"), '\\b(store|product)\\s+(\\d+)\\b', '\\1_\\2', 'g') AS joined FROM questions)),
worded AS (SELECT *, CASE {' '.join(f"WHEN regexp_matches(lower(text), '{_any(w)}') THEN '{n}'" for n, w in _groups)}
  ELSE 'out_of_scope' END AS words FROM params_of),
classified AS (SELECT * EXCLUDE (words, joined), CASE WHEN regexp_matches(lower("text"), '^\\s*{_any(tx.GREETINGS)}') THEN 'greeting'
  WHEN words <> 'out_of_scope' THEN words WHEN len(store_id) + len(transfer_id) > 0 THEN 'explain_transfer'
  WHEN len(manufacturing_id) > 0 THEN 'explain_manufacturing' WHEN len(product_id) > 0 THEN 'explain_transfer'
  ELSE 'out_of_scope' END AS intent FROM worded),
scanned AS (SELECT *, last_value(CASE WHEN intent NOT IN ('out_of_scope', 'greeting') THEN intent END IGNORE NULLS)
  OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS last_intent FROM classified),
carried AS (SELECT * REPLACE (CASE WHEN intent = 'out_of_scope' AND last_intent IS NOT NULL AND is_all THEN last_intent ELSE intent END AS intent)
  FROM scanned)"""
_mark = "list_transform({ids}, lambda x: '{m}:' || lower(x))"
ASKED = f"""
tokened AS (SELECT *, list_sort(list_distinct(CASE intent
  WHEN 'explain_transfer' THEN {_mark.format(ids='transfer_id', m='t')} || {_mark.format(ids='product_id', m='p')} || {_mark.format(ids='store_id', m='s')}
  WHEN 'explain_manufacturing' THEN {_mark.format(ids='manufacturing_id', m='m')} || {_mark.format(ids='product_id', m='p')}
  ELSE CAST([] AS VARCHAR[]) END)) AS tokens FROM carried),
asked AS (SELECT *, CASE WHEN intent IN ('scenario_summary', 'impact_analysis') THEN 'scenario' ELSE intent END || '|'
  || array_to_string(tokens, ',') AS answer_key FROM tokened)"""
Q = with_views(QUESTIONS, CLASSIFIED)
QA = with_views(QUESTIONS, CLASSIFIED, ASKED)
RECORDS = f"""
short AS (SELECT store_id, product_id, greatest(total_demand_7d - current_inventory, 0) AS short FROM targets),
t0 AS (SELECT r.*, row_number() OVER (ORDER BY r.product_id, from_store, to_store) AS n, CAST(round_even(short, 0) AS BIGINT) AS b,
  CAST(round_even(greatest(short - CAST(qty AS DOUBLE), 0), 0) AS BIGINT) AS a, round_even(cost, 2) AS moved,
  round_even(-1.0::DOUBLE * CAST(qty AS DOUBLE), 2) AS held FROM reasoned r JOIN short s ON s.store_id = to_store AND s.product_id = r.product_id),
transfer_records AS (SELECT n - 1 AS position, format('T{{:03d}}', n) AS transfer_id, 'store_' || from_store AS from_store, 'store_' || to_store AS to_store,
  'product_' || product_id AS product_id, CAST(round_even(CAST(qty AS DOUBLE), 0) AS BIGINT) AS quantity, reason_codes, moved AS transport_cost,
  held AS holding_cost_change, (b - a) * 25.0::DOUBLE AS stockout_penalty_avoided, moved + held - (b - a) * 25.0::DOUBLE AS net_cost_change,
  b AS baseline_stockout_units, a AS post_transfer_stockout_units, coalesce(CAST(b - a AS DOUBLE) / nullif(b, 0), 0) AS stockout_reduction_pct FROM t0),
by_product AS (SELECT product_id, sum(qty) AS quantity, sum(cost) AS cost, list_sort(list_distinct(flatten(list(reason_codes)))) AS reason_codes
  FROM reasoned_made GROUP BY 1),
manufacturing_records AS (SELECT row_number() OVER (ORDER BY product_id) - 1 AS position, format('M{{:03d}}', row_number() OVER (ORDER BY product_id)) AS manufacturing_id,
  'product_' || product_id AS product_id, CAST(round_even(quantity, 0) AS BIGINT) AS quantity, reason_codes, round_even(cost, 2) AS manufacturing_cost FROM by_product)"""
_spaced = "array_to_string(list_transform(reason_codes, lambda c: replace(c, '_', ' ')), ', ')"
_usd = "'$' || format('{{:,.0f}}', {x})"
SECTIONS = f"""
transfer_sections AS (SELECT position, ['t:' || lower(transfer_id), 'p:' || product_id, 's:' || from_store, 's:' || to_store] AS ids,
  '---' || chr(10) || '**' || transfer_id || ' — ' || product_id || '**  ' || chr(10) || 'Route: ' || from_store || ' → ' || to_store || '  ' || chr(10)
  || 'Quantity: **' || quantity || ' units**  ' || chr(10) || 'Reasons: ' || {_spaced} || '  ' || chr(10) || chr(10) || '| Metric | Value |' || chr(10)
  || '|--------|-------|' || chr(10) || '| Transport cost | ' || {_usd.format(x='transport_cost')} || ' |' || chr(10)
  || '| Holding cost change | ' || {_usd.format(x='holding_cost_change')} || ' |' || chr(10)
  || '| Stockout penalty avoided | ' || {_usd.format(x='stockout_penalty_avoided')} || ' |' || chr(10)
  || '| **Net cost change** | **' || {_usd.format(x='net_cost_change')} || '** |' || chr(10)
  || '| Stockout before | ' || baseline_stockout_units || ' units |' || chr(10) || '| Stockout after | ' || post_transfer_stockout_units || ' units |' || chr(10)
  || '| Stockout reduction | ' || format('{{:.1f}}', stockout_reduction_pct * 100) || '% |' AS section FROM transfer_records),
manufacturing_sections AS (SELECT position, ['m:' || lower(manufacturing_id), 'p:' || product_id] AS ids,
  '---' || chr(10) || '**' || manufacturing_id || ' — ' || product_id || '**  ' || chr(10) || 'Quantity to manufacture: **' || quantity || ' units**  ' || chr(10)
  || 'Reasons: ' || {_spaced} || '  ' || chr(10) || chr(10) || '| Metric | Value |' || chr(10) || '|--------|-------|' || chr(10)
  || '| Manufacturing cost | ' || {_usd.format(x='manufacturing_cost')} || ' |' || chr(10) || '| Distribution cost | $0 |' || chr(10)
  || '| **Total cost** | **' || {_usd.format(x='manufacturing_cost')} || '** |' AS section FROM manufacturing_records)"""
TO_RECORDS = TO_COSTS.rstrip() + "," + RECORDS
TO_ANSWERS = TO_COSTS.rstrip() + "," + ",".join([RECORDS, SECTIONS, QUESTIONS, CLASSIFIED, ASKED])


def _hits_sql(sections: str, intent: str) -> str:
    return f""", wanted AS (SELECT DISTINCT answer_key, tokens FROM asked WHERE intent = '{intent}'),
    hits AS (SELECT answer_key, position, section FROM wanted, {sections} WHERE len(tokens) = 0 OR list_has_any(tokens, ids))"""


def _rows_sql(sections: str, intent: str, noun: str, nothing: str) -> str:
    """The answers as rows: the header at place 0, records after it."""
    return f"""wanted_{intent} AS (SELECT DISTINCT answer_key, tokens FROM asked WHERE intent = '{intent}'),
    hits_{intent} AS (SELECT answer_key, position, section FROM wanted_{intent}, {sections} WHERE len(tokens) = 0 OR list_has_any(tokens, ids)),
    counts_{intent} AS (SELECT answer_key, count(*) AS n FROM hits_{intent} GROUP BY 1),
    rows_{intent} AS (SELECT answer_key, CAST(0 AS BIGINT) AS place, CASE WHEN n > 0 THEN '**Scenario:** {SCENARIO}  ' || chr(10)
      || '**Matching {noun}:** ' || n ELSE '{nothing}' END AS section FROM wanted_{intent} LEFT JOIN counts_{intent} USING (answer_key)
      UNION ALL SELECT answer_key, CAST(position + 1 AS BIGINT), section FROM hits_{intent})"""


TRANSFER_ROWS = _rows_sql("transfer_sections", "explain_transfer", "transfers", tx.NO_TRANSFERS)
MANUFACTURING_ROWS = _rows_sql("manufacturing_sections", "explain_manufacturing", "manufacturing actions", tx.NO_MANUFACTURING)


def asked(spark, folder):
    return an.requests(an.understood(views.questions(spark, folder)))


def scenario_name(spark):
    return spark.range(1).select(F.lit(SCENARIO).alias("scenario"))


_lists = "transfer_id, manufacturing_id, product_id, store_id"


@query("n01_n02_n04_intents", Q + "SELECT conv_id, turn, intent FROM classified")
def intents(spark, folder):
    return an.classify(views.questions(spark, folder)).select("conv_id", "turn", "intent")


@query("n01_strict_greetings", Q + f"""SELECT conv_id, turn, regexp_matches(lower("text"), '^\\s*{_any(tx.GREETINGS)}') AS by_prefix,
    regexp_matches(lower("text"), '^\\s*{_any(tx.GREETINGS)}\\b') AS by_word FROM questions""")
def strict_greetings(spark, folder):
    return views.questions(spark, folder).select(
        "conv_id", "turn", tx.is_greeting(F.lower("text")).alias("by_prefix"), tx.is_greeting(F.lower("text"), strict=True).alias("by_word")
    )


@query("n02_document_keywords", f"""SELECT doc_id, CASE {' '.join(f"WHEN regexp_matches(lower(text), '{_any(w)}') THEN '{n}'" for n, w in _groups)}
    ELSE 'out_of_scope' END AS words, len(regexp_extract_all(lower("text"), '\\b(store|product)\\s+\\d+\\b')) AS n_named FROM documents""")
def document_keywords(spark, folder):
    """Keyword rules over whole documents."""
    named = F.size(F.regexp_extract_all(F.lower("text"), F.lit(r"(?U)\b(store|product)\s+\d+\b"), F.lit(0)))
    return views.table(spark, folder, "documents").select(
        "doc_id", tx.keyword_intent(F.lower("text")).alias("words"), named.cast("bigint").alias("n_named")
    )


@query("n03_parameters", Q + f"SELECT conv_id, turn, {_lists}, is_all FROM params_of")
def parameters(spark, folder):
    return an.parameters(views.questions(spark, folder)).drop("text")


@query("n05_w11_carried_intents", Q + "SELECT conv_id, turn, intent FROM carried")
def carried_intents(spark, folder):
    return an.understood(views.questions(spark, folder)).select("conv_id", "turn", "intent")


@query("n15_intent_distribution", Q + "SELECT intent, count(*) AS n_questions FROM carried GROUP BY 1")
def intent_distribution(spark, folder):
    return an.intent_distribution(an.understood(views.questions(spark, folder)))


@query("n11_n13_n16_requests", QA + f"""SELECT conv_id, turn, answer_key, CASE intent {' '.join(f"WHEN '{k}' THEN '{v}'" for k, v in tx.INTENT_LABELS.items())}
    ELSE intent END AS label, intent NOT IN ('out_of_scope', 'greeting')
    AND len(transfer_id) + len(manufacturing_id) + len(product_id) + len(store_id) > 0 AS filter_applied FROM asked""")
def requests(spark, folder):
    return asked(spark, folder).select("conv_id", "turn", "answer_key", "label", "filter_applied")


@query("n17_fixed_replies", QA + f"""SELECT conv_id, turn, CASE intent WHEN 'greeting' THEN '{tx.GREETING_REPLY.replace("'", "''")}'
    ELSE '{tx.OUT_OF_SCOPE_REPLY.replace("'", "''")}' END AS "text" FROM asked WHERE intent IN ('greeting', 'out_of_scope')""")
def fixed_replies(spark, folder):
    questions = asked(spark, folder).select("conv_id", "turn", "answer_key")
    return questions.join(F.broadcast(an.fixed_replies(questions)), "answer_key").drop("answer_key", "scenario")  # two rows


@query("l15_transfer_records", TO_RECORDS + """SELECT transfer_id, from_store, to_store, product_id, quantity, reason_codes, transport_cost,
    holding_cost_change, stockout_penalty_avoided, round(net_cost_change, 3) AS net_cost_change, baseline_stockout_units,
    post_transfer_stockout_units, round(stockout_reduction_pct, 9) AS stockout_reduction_pct FROM transfer_records""")
def transfer_records(spark, folder):
    flat = run(spark, folder).transfer_records(SCENARIO).select(
        "transfer_id", "from_store", "to_store", "product_id", "quantity", "reason_codes", "cost_impact.*", "service_level_impact.*"
    )
    return flat.withColumns(
        {"net_cost_change": F.round("net_cost_change", 3), "stockout_reduction_pct": F.round("stockout_reduction_pct", 9)}
    )


@query("l15_manufacturing_records", TO_RECORDS + """SELECT manufacturing_id, product_id, quantity AS manufacture_quantity, reason_codes,
    manufacturing_cost, CAST(0 AS DOUBLE) AS distribution_cost, manufacturing_cost AS total_manufacturing_cost FROM manufacturing_records""")
def manufacturing_records(spark, folder):
    return run(spark, folder).manufacturing_records(SCENARIO).select(
        "manufacturing_id", "product_id", "manufacture_quantity", "reason_codes", "cost_impact.*"
    )


def _record_answers(spark, folder, sections, intent):
    questions, kept = settle(asked(spark, folder)), settle(sections)
    return an.record_answers(questions, kept, intent, scenario_name(spark)).drop("scenario")


@query("n06_transfer_sections", TO_ANSWERS + " SELECT CAST(position AS BIGINT) AS position, section FROM transfer_sections")
def transfer_sections(spark, folder):
    return an.transfer_sections(run(spark, folder).transfer_records(SCENARIO)).select("position", "section")


@query("j12_transfer_matches", TO_ANSWERS + _hits_sql("transfer_sections", "explain_transfer") + " SELECT answer_key, CAST(position AS BIGINT) AS position FROM hits")
def transfer_matches(spark, folder):
    sections = an.transfer_sections(run(spark, folder).transfer_records(SCENARIO)).select("scenario", "position", "tokens")
    return an.matches(settle(asked(spark, folder)), settle(sections), "explain_transfer").drop("scenario")


@query("n06_j12_transfer_answers", TO_ANSWERS + ", " + TRANSFER_ROWS + " SELECT * FROM rows_explain_transfer")
def transfer_answers(spark, folder):
    sections = an.transfer_sections(run(spark, folder).transfer_records(SCENARIO))
    return _record_answers(spark, folder, sections, "explain_transfer")


@query("n07_manufacturing_answers", TO_ANSWERS + ", " + MANUFACTURING_ROWS + " SELECT * FROM rows_explain_manufacturing")
def manufacturing_answers(spark, folder):
    sections = an.manufacturing_sections(run(spark, folder).manufacturing_records(SCENARIO))
    return _record_answers(spark, folder, sections, "explain_manufacturing")


SCENARIO_ROWS = COSTS + """, state AS (SELECT
    CAST(sum(greatest(need - current, 0)) AS DOUBLE) AS before, CAST(sum(greatest(need - final, 0)) AS DOUBLE) AS after,
    CAST(sum(current) AS DOUBLE) AS stock FROM (SELECT *, CAST(total_demand_7d AS DECIMAL(24,6)) AS need FROM plan
    JOIN (SELECT store_id, product_id, total_demand_7d FROM targets) USING (store_id, product_id))),
    v AS (SELECT round_even(stock + 25 * before, 2) AS c0, round_even(total_cost + 25 * after, 2) AS c1,
    CAST(round_even(before, 0) AS BIGINT) AS s0, CAST(round_even(after, 0) AS BIGINT) AS s1 FROM state, costs),
    scenario_answers AS (SELECT 'scenario|' AS answer_key, '**Scenario:** weekly_plan' || chr(10) || chr(10) || '| | Baseline | Optimized |' || chr(10) || '|---|---|---|' || chr(10)
    || '| Total cost | $' || format('{:,.0f}', c0) || ' | $' || format('{:,.0f}', c1) || ' |' || chr(10)
    || '| Total stockouts | ' || s0 || ' units | ' || s1 || ' units |' || chr(10) || chr(10) || '**Improvement after optimization:**' || chr(10) || chr(10)
    || '| Metric | Value |' || chr(10) || '|--------|-------|' || chr(10) || '| Cost change | $' || format('{:,.0f}', c1 - c0) || ' |' || chr(10)
    || '| Stockout units reduced | ' || (s0 - s1) || ' |' || chr(10)
    || '| Stockout reduction | ' || format('{:.1f}', CAST(s0 - s1 AS DOUBLE) / s0 * 100) || '% |' AS "text" FROM v)"""


@query("n08_scenario_answer", TO_COSTS.rstrip() + "," + SCENARIO_ROWS + " SELECT * FROM scenario_answers")
def scenario_answer(spark, folder):
    return an.scenario_answer(run(spark, folder).scenario_record(SCENARIO)).drop("scenario")


NAMED = """, named AS (SELECT DISTINCT kind, id FROM (SELECT 'product' AS kind, product_id AS id FROM transfer_records
    UNION ALL SELECT 'product', product_id FROM manufacturing_records UNION ALL SELECT 'store', from_store FROM transfer_records
    UNION ALL SELECT 'store', to_store FROM transfer_records))"""


@query("a36_u02_entities", TO_RECORDS + NAMED + " SELECT kind, id FROM named")
def entities(spark, folder):
    made = run(spark, folder)
    return an.entities(made.transfer_records(SCENARIO), made.manufacturing_records(SCENARIO)).drop("scenario")


ENTITY_ROWS = """numbered AS (SELECT kind, id, row_number() OVER (ORDER BY kind, id) AS n FROM named),
    entity_rows AS (SELECT 'list_entities|' AS answer_key, CAST(0 AS BIGINT) AS place, '**Scenario:** weekly_plan' || chr(10) || chr(10)
      || '**Products involved/at risk**:' AS section
    UNION ALL SELECT 'list_entities|', count(*) FILTER (kind = 'product') + 1, chr(10) || '**Stores involved**:' FROM named
    UNION ALL SELECT 'list_entities|', n + CASE WHEN kind = 'store' THEN 1 ELSE 0 END, '- ' || id FROM numbered)"""


@query("n09_entity_answer", TO_RECORDS + NAMED + ", " + ENTITY_ROWS + " SELECT * FROM entity_rows")
def entity_answer(spark, folder):
    made = run(spark, folder)
    named = an.entities(made.transfer_records(SCENARIO), made.manufacturing_records(SCENARIO))
    return an.entity_answer(named, scenario_name(spark)).drop("scenario")


COUNT_ROWS = """count_answers AS (SELECT 'total_counts|' AS answer_key, '**Scenario:** weekly_plan' || chr(10) || chr(10)
    || '**Overall Summary Metrics:**' || chr(10) || '- Total Transfer Recommendations: **' || (SELECT count(*) FROM transfer_records) || '**' || chr(10)
    || '- Total Manufacturing Decisions: **' || (SELECT count(*) FROM manufacturing_records) || '**' || chr(10) || '- Unique Products Affected: **'
    || (SELECT count(*) FROM (SELECT product_id FROM transfer_records UNION SELECT product_id FROM manufacturing_records)) || '**' AS "text")"""


@query("n10_a37_count_answer", TO_RECORDS + ", " + COUNT_ROWS + " SELECT * FROM count_answers")
def count_answer(spark, folder):
    made = run(spark, folder)
    counts = an.result_counts(made.transfer_records(SCENARIO), made.manufacturing_records(SCENARIO))
    return an.count_answer(counts, scenario_name(spark)).drop("scenario")


FIXED_ROWS = f"""fixed_answers AS (SELECT 'greeting|' AS answer_key, '{tx.GREETING_REPLY.replace("'", "''")}' AS "text"
    UNION ALL SELECT 'out_of_scope|', '{tx.OUT_OF_SCOPE_REPLY.replace("'", "''")}')"""
_at_once = "UNION ALL SELECT answer_key, CAST(0 AS BIGINT), \"text\" FROM {}"


@query("n11_n12_all_answers", TO_ANSWERS + ", " + ", ".join(
    [TRANSFER_ROWS, MANUFACTURING_ROWS, SCENARIO_ROWS, NAMED.lstrip(", "), ENTITY_ROWS, COUNT_ROWS, FIXED_ROWS]) + f""",
    every AS (SELECT * FROM rows_explain_transfer UNION ALL SELECT * FROM rows_explain_manufacturing UNION ALL SELECT * FROM entity_rows
    {' '.join(_at_once.format(t) for t in ('scenario_answers', 'count_answers', 'fixed_answers'))})
    SELECT *, answer_key IN ('list_entities|', 'total_counts|') OR section IN ('{tx.NO_TRANSFERS}', '{tx.NO_MANUFACTURING}') AS as_is FROM every""")
def all_answers(spark, folder):
    """Every answer there is, of any length, as rows, with the flag of those that are shown as they are."""
    made = run(spark, folder)
    moved, produced = settle(made.transfer_records(SCENARIO)), settle(made.manufacturing_records(SCENARIO))
    questions = settle(asked(spark, folder))
    return answer_rows(
        questions, an.transfer_sections(moved), an.manufacturing_sections(produced), moved, produced, made.scenario_record(SCENARIO)
    ).drop("scenario")


@query("n14_records_missing_fields", TO_RECORDS + """SELECT transfer_id, ['cost_impact'] AS missing FROM transfer_records WHERE baseline_stockout_units <= 0""")
def records_missing_fields(spark, folder):
    """Records lacking a required field, after dropping the cost of every record without a stock-out."""
    records = run(spark, folder).transfer_records(SCENARIO)
    some = F.col("service_level_impact.baseline_stockout_units") > 0
    cut = records.withColumn("cost_impact", F.when(some, F.col("cost_impact")))
    return an.missing_fields(cut, schemas.REQUIRED["transfer"]).select("transfer_id", "missing")
