"""Rule evaluation, scoring, failing-row samples, gate and summaries.

Row rules on one table become one aggregate over one scan. Reference checks on
the same key share one grouping, and everything that is asked per order comes
from one ledger grouped by order id, references to orders included: 36 rules become
16 aggregates in one job.
"""

from __future__ import annotations

import datetime as dt
from collections import ChainMap
from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from os.path import commonprefix
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from martloom.functions import money as m
from martloom.functions.dates import as_date
from martloom.operators.aggregates import surplus_duplicates
from martloom.operators.joins import existing, match, missing
from martloom.plans.quality_rules import RULES, Rule
from martloom.session import freed_shuffles

Tables = Mapping[str, DataFrame]
MIN_ROWS = 10
SAMPLES_PER_RULE = 10
SAMPLE_CHARS = 500  # of a sampled row's text
CANDIDATES = 4096  # rows that are tried before a whole dataset is looked through
LEAD = "__lead"
COUNT_SCHEMA = "rule_id string, failed_records long"


class QualityGateError(ValueError):
    """A blocking rule failed."""


def _kind(rule: Rule) -> tuple[str, str]:
    kind, _, text = rule.check.partition(":")
    return kind.strip(), text.strip()


def _predicate(text: str, as_of: dt.date) -> Column:
    return F.expr(text.replace(":as_of", f"DATE '{as_of.isoformat()}'"))


# --- set checks: frames of violating rows -------------------------------------------------


def line_totals(t: Tables) -> DataFrame:
    """Gross and discount per order, in cents."""
    return t["order_items"].groupBy("order_id").agg(
        m.units_to_cents(F.sum(m.line_total_units())).alias("line_gross"),
        m.units_to_cents(F.sum(m.line_discount_units())).alias("line_discounts"),
    )


def headers_with_lines(t: Tables) -> DataFrame:
    """Orders that have lines, with what their lines add up to."""
    return match(t["orders"], line_totals(t), "order_id")


def return_without_line(t: Tables, as_of: dt.date) -> DataFrame:
    return missing(t["returns"], t["order_items"], ["order_id", "product_id"])


def eligible_purchases(t: Tables) -> DataFrame:
    """Distinct (customer, product) of completed or returned orders, with the first order date."""
    done = t["orders"].where(F.col("status").isin("Completed", "Returned"))
    bought = match(t["order_items"].select("order_id", "product_id"),
                   done.select("order_id", "customer_id", as_date("order_date").alias("order_date")), "order_id")
    return bought.groupBy("customer_id", "product_id").agg(F.min("order_date").alias("first_bought"))


def unverified_review(t: Tables, as_of: dt.date) -> DataFrame:
    verified = t["product_reviews"].where(F.col("verified_purchase"))
    return missing(verified, eligible_purchases(t), ["customer_id", "product_id"])


def negative_stock(t: Tables, as_of: dt.date) -> DataFrame:
    stock = t["inventory_events"].groupBy("product_id", "warehouse_id").agg(F.sum("quantity").alias("stock"))
    return stock.where(F.col("stock") < 0)


def return_date_out_of_order(t: Tables, as_of: dt.date) -> DataFrame:
    orders = t["orders"].select("order_id", as_date("order_date").alias("ordered"))
    r = match(t["returns"], orders, "order_id")
    returned = as_date("return_date")
    return r.where((returned <= F.col("ordered")) | (returned > F.lit(as_of)))


SET_CHECKS: dict[str, Callable[[Tables, dt.date], DataFrame]] = {
    f.__name__: f
    for f in (
        return_without_line, unverified_review, negative_stock, return_date_out_of_order,
    )
}


IN_LEDGER = ("payments", "shipments", "returns")


def order_ledger(t: Tables) -> DataFrame:
    """Per order id: how many orders, payments, shipments and returns of each kind there are.

    Inputs are counted in every task before the shuffle, so one order id with
    very many rows costs one row per task.
    """
    measures = {
        "orders": ("orders", None),
        "cancelled": ("orders", F.col("status") == "Cancelled"),
        "returned": ("orders", F.col("status") == "Returned"),
        "live": ("orders", F.col("status") != "Cancelled"),
        "payments": ("payments", None),
        "paid": ("payments", F.col("status") == "Completed"),
        "shipments": ("shipments", None),
        "returns": ("returns", None),
        "approved": ("returns", F.col("status") == "Approved"),
    }

    def counted(table: str) -> DataFrame:
        one = {
            name: F.lit(0) if source != table else F.lit(1) if cond is None else F.when(cond, 1).otherwise(0)
            for name, (source, cond) in measures.items()
        }
        return t[table].select("order_id", *[c.alias(name) for name, c in one.items()])

    rows = reduce(DataFrame.unionAll, [counted(x) for x in ("orders", *IN_LEDGER)])
    return rows.groupBy("order_id").agg(*[F.sum(name).alias(name) for name in measures])


# --- counting -------------------------------------------------------------------------------


def _long_form(row: DataFrame, names: Sequence[str]) -> DataFrame:
    """One-row aggregate -> (rule_id, failed_records) rows."""
    pairs = [F.struct(F.lit(n).alias("rule_id"), F.col(f"`{n}`").cast("bigint").alias("failed_records")) for n in names]
    return row.select(F.inline(F.array(*pairs)))


ROWS = "rows:"  # prefix of a dataset's row count among the violation counts


def _row_rules(df: DataFrame, rules: Sequence[Rule], as_of: dt.date, dataset: str | None = None) -> DataFrame:
    """Counts of all row rules of one table in one scan, with its row count beside them if `dataset` is named."""
    aggs = [F.count(F.lit(1)).alias(ROWS + dataset)] if dataset else []
    for r in rules:
        kind, text = _kind(r)
        count = surplus_duplicates(text) if kind == "unique" else F.count_if(_predicate(text, as_of))
        aggs.append(count.alias(r.rule_id))
    names = [r.rule_id for r in rules]
    return _long_form(df.agg(*aggs), [ROWS + dataset, *names] if dataset else names)


def _outside(key: Column, reference: Column, rows: Column) -> Column:
    """Violations of NOT IN over one row per key with its number of reference rows and of checked rows."""
    null_ref = F.coalesce(F.sum(F.when(key.isNull(), reference)), F.lit(0))
    ref_rows = F.coalesce(F.sum(reference), F.lit(0))
    orphans = F.sum(F.when(key.isNotNull() & (reference == 0), rows).otherwise(0))
    return F.when(ref_rows == 0, F.sum(rows)).when(null_ref > 0, 0).otherwise(orphans)


def _reference_rules(t: Tables, key: str, reference: str, rules: Sequence[Rule]) -> DataFrame:
    """NOT IN against one reference key for several tables in one grouping."""
    names = ["_ref", *[r.rule_id for r in rules]]

    def tagged(df: DataFrame, mine: str) -> DataFrame:
        return df.select(F.col(key).alias("k"), *[F.lit(int(n == mine)).alias(n) for n in names])

    parts = [tagged(t[reference], "_ref"), *[tagged(t[r.dataset], r.rule_id) for r in rules]]
    per_key = reduce(DataFrame.unionAll, parts).groupBy("k").agg(*[F.sum(n).alias(n) for n in names])
    counts = [_outside(F.col("k"), F.col("_ref"), F.col(r.rule_id)).alias(r.rule_id) for r in rules]
    return _long_form(per_key.agg(*counts), [r.rule_id for r in rules])


def _ledger_rules(t: Tables, rules: Sequence[Rule]) -> DataFrame:
    """Rules on the ledger, and NOT IN against the orders for the tables it counts."""
    ledger, counts = order_ledger(t), []
    for r in rules:
        kind, text = _kind(r)
        if kind == "not_in":
            count = _outside(F.col("order_id"), F.col("orders"), F.col(r.dataset))
        else:
            count = F.coalesce(F.sum(F.expr(text)), F.lit(0))
        counts.append(count.alias(r.rule_id))
    return _long_form(ledger.agg(*counts), [r.rule_id for r in rules])


def _set_rule(t: Tables, rule: Rule, as_of: dt.date) -> DataFrame:
    rows = SET_CHECKS[_kind(rule)[1]](t, as_of)
    return rows.agg(F.count(F.lit(1)).alias("failed_records")).select(F.lit(rule.rule_id).alias("rule_id"), "*")


def _sql_rule(spark: SparkSession, t: Tables, rule: Rule) -> DataFrame:
    text = _kind(rule)[1]
    count = spark.sql(text, **{n: t[n] for n in t if "{" + n + "}" in text})
    return count.select(F.lit(rule.rule_id).alias("rule_id"), F.col(count.columns[0]).cast("bigint").alias("failed_records"))


def violation_counts(
    spark: SparkSession, t: Tables, rules: Sequence[Rule], as_of: dt.date, with_rows: bool = False
) -> DataFrame:
    """(rule_id, failed_records) of every enabled rule, as one lazy frame.

    `with_rows` adds the row count of every checked dataset, taken in the same scans.
    """
    groups: dict[tuple, list[Rule]] = {}
    ledger = any(r.enabled and _kind(r)[0] == "ledger" for r in rules)
    for r in rules:
        if not r.enabled:
            continue
        kind, text = _kind(r)
        if kind in ("where", "unique"):
            group = ("row", r.dataset)
        elif kind == "not_in" and ledger and text.split() == ["order_id", "orders"] and r.dataset in IN_LEDGER:
            group = ("ledger",)  # its grouping holds what the rule asks
        elif kind == "not_in":
            group = ("ref", *text.split())
        elif kind in ("ledger", "header"):
            group = (kind,)
        else:
            group = (kind, r.rule_id)
        groups.setdefault(group, []).append(r)
    parts = []
    for group, members in groups.items():
        if group[0] == "row":
            parts.append(_row_rules(t[group[1]], members, as_of, group[1] if with_rows else None))
        elif group[0] == "header":
            parts.append(_row_rules(headers_with_lines(t), members, as_of))
        elif group[0] == "ref":
            parts.append(_reference_rules(t, group[1], group[2], members))
        elif group[0] == "ledger":
            parts.append(_ledger_rules(t, members))
        elif group[0] == "rows":
            parts.extend(_set_rule(t, r, as_of) for r in members)
        elif group[0] == "sql":
            parts.extend(_sql_rule(spark, t, r) for r in members)
        else:
            raise ValueError(f"unknown check kind: {members[0].check}")
    if with_rows:
        scanned = {group[1] for group in groups if group[0] == "row"}
        for name in dict.fromkeys(r.dataset for r in rules if r.enabled and r.dataset not in scanned):
            parts.append(_row_rules(t[name], [], as_of, name))
    if not parts:
        return spark.createDataFrame([], COUNT_SCHEMA)
    return reduce(DataFrame.unionByName, parts)


def dataset_counts(spark: SparkSession, t: Tables, rules: Sequence[Rule]) -> DataFrame:
    """Rows per checked dataset; a missing one counts 0."""
    parts = []
    for name in dict.fromkeys(r.dataset for r in rules if r.enabled):
        try:
            rows = t[name].agg(F.count(F.lit(1)).alias("total_records"))
        except Exception:  # a failed read arrives in many forms
            rows = spark.createDataFrame([(0,)], "total_records long")
        parts.append(rows.select(F.lit(name).alias("dataset"), "total_records"))
    return reduce(DataFrame.unionByName, parts)


def small_datasets(counts: DataFrame, below: int = MIN_ROWS) -> DataFrame:
    """Datasets too small to trust. A warning only."""
    return counts.where(F.col("total_records") < below)


def in_halves(items: Sequence, run: Callable[[Sequence], list]) -> tuple[list, list[tuple]]:
    """Rows of `run(items)`; where that breaks, of both halves in turn, down to the items that break alone.

    Returns the rows and (item, exception) of the broken items. A few broken items among many cost about twice the
    logarithm of their number in runs, and the others still share their scans.
    """
    if not items:
        return [], []
    try:
        return list(run(items)), []
    except Exception as e:  # a task that fails while reading raises no PySparkException
        if len(items) == 1:
            return [], [(items[0], e)]
    half = len(items) // 2
    (first, bad), (second, worse) = in_halves(items[:half], run), in_halves(items[half:], run)
    return first + second, bad + worse


def counts_with_errors(
    spark: SparkSession, t: Tables, rules: Sequence[Rule], as_of: dt.date
) -> tuple[DataFrame, DataFrame, dict[str, str]]:
    """Violation counts, dataset row counts, and the message of every rule that could not be evaluated.

    The fused plan is tried first, without the set checks, which join whole tables and share nothing with it: each is a
    job after it, so that their shuffles do not lie on disk together. If anything in them breaks, the rules are halved
    until the broken ones are alone, so that they cannot hide the others, which stay fused. A dataset that cannot be
    counted has 0 rows.
    """
    active = [r for r in rules if r.enabled]
    errors: dict[str, str] = {}
    with freed_shuffles(spark):
        try:
            rows, named = [], set()
            fused = [r for r in active if _kind(r)[0] != "rows"]
            for some in [fused, *[[r] for r in active if r not in fused]]:
                new = not named.issuperset(r.dataset for r in some)
                rows += [tuple(x) for x in violation_counts(spark, t, some, as_of, with_rows=new).collect()]
                named.update(r.dataset for r in some)
        except Exception:  # a task that fails while reading raises no PySparkException
            # rules on one dataset stay next to each other, so a damaged one costs its own group only
            grouped = sorted(active, key=lambda r: r.dataset)
            names = list({r.dataset: r for r in grouped}.values())
            counted, lost = in_halves(names, lambda some: dataset_counts(spark, t, some).collect())
            rows = [(ROWS + r.dataset, r.total_records) for r in counted] + [(ROWS + r.dataset, 0) for r, _ in lost]
            found, broken = in_halves(grouped, lambda some: violation_counts(spark, t, some, as_of).collect())
            rows += [tuple(x) for x in found]
            errors = {r.rule_id: str(e)[:200] for r, e in broken}
    totals = [(name.removeprefix(ROWS), n) for name, n in rows if name.startswith(ROWS)]
    counts = [(name, n) for name, n in rows if not name.startswith(ROWS)]
    return (
        spark.createDataFrame(counts, COUNT_SCHEMA),
        spark.createDataFrame(totals, "dataset string, total_records long"),
        errors,
    )


# --- results ---------------------------------------------------------------------------------


def rules_frame(spark: SparkSession, rules: Sequence[Rule] = RULES) -> DataFrame:
    return spark.createDataFrame(
        [tuple(r) for r in rules],
        "rule_id string, dataset string, field string, rule_type string, severity string, threshold double,"
        " check_expression string, description string, enabled boolean",
    )


def rules_from_frame(df: DataFrame) -> list[Rule]:
    """Rules kept as rows of a table (a few hundred at most)."""
    return [
        Rule(r.rule_id, r.dataset, r.field, r.rule_type, r.severity, r.threshold, r.check_expression, r.description, r.enabled)
        for r in df.where("enabled").orderBy("rule_id").collect()
    ]


def score(
    rules: DataFrame, counts: DataFrame, totals: DataFrame, errors: Mapping[str, str], run_id: str, at: dt.datetime
) -> DataFrame:
    """The result row of every enabled rule."""
    failed = F.coalesce("failed_records", F.lit(0))
    total = F.coalesce("total_records", F.lit(0))
    failure_pct = F.when(total > 0, m.pct(failed, total, 4)).otherwise(F.lit(0.0))
    broken = F.col("rule_id").isin(*errors) if errors else F.lit(False)
    status = F.when(broken, "ERROR").when(failure_pct <= F.col("threshold"), "PASS").otherwise("FAIL")
    joined = rules.where("enabled").join(counts, "rule_id", "left").join(totals, "dataset", "left")
    return joined.select(
        F.concat("rule_id", F.lit(f"_{run_id}")).alias("result_id"), "rule_id", "dataset", "field", "severity",
        "rule_type", "description", total.alias("total_records"),
        F.greatest(total - failed, F.lit(0)).alias("passed_records"), failed.alias("failed_records"),
        failure_pct.alias("failure_pct"), "threshold", status.alias("status"), F.lit(run_id).alias("run_id"),
        F.lit(at).alias("evaluated_at"),
    )


def run_rules(
    spark: SparkSession, t: Tables, as_of: dt.date, run_id: str, at: dt.datetime, rules: Sequence[Rule] = RULES
) -> tuple[DataFrame, dict[str, str]]:
    """Evaluate and score. The result holds one row per rule."""
    counts, totals, errors = counts_with_errors(spark, t, rules, as_of)
    return score(rules_frame(spark, rules), counts, totals, errors, run_id, at), errors


def violating_rows(t: Tables, rule: Rule, as_of: dt.date) -> DataFrame:
    """The rows behind a rule's count (for uniqueness: all rows of a repeated key)."""
    kind, text = _kind(rule)
    if kind == "where":
        return t[rule.dataset].where(_predicate(text, as_of))
    if kind == "header":
        return headers_with_lines(t).where(_predicate(text, as_of))
    if kind == "unique":
        repeated = t[rule.dataset].groupBy(text).agg(F.count(F.lit(1)).alias("n"))
        repeated = repeated.where((F.col("n") > 1) | F.col(text).isNull()).select(F.col(text).alias("_k"))
        df = t[rule.dataset]
        return df.join(repeated, df[text].eqNullSafe(F.col("_k")), "left_semi")
    if kind == "not_in":
        key, reference = text.split()
        return missing(t[rule.dataset].where(F.col(key).isNotNull()), t[reference], key)
    if kind == "rows":
        return SET_CHECKS[text](t, as_of)
    orders, paid = t["orders"], t["payments"].where(F.col("status") == "Completed")
    cancelled = orders.where(F.col("status") == "Cancelled")
    if rule.rule_id == "QR029":
        return existing(t["shipments"], cancelled, "order_id")
    if rule.rule_id == "QR031":
        approved = t["returns"].where(F.col("status") == "Approved")
        return missing(orders.where(F.col("status") == "Returned"), approved, "order_id")
    if rule.rule_id == "QR032":
        return missing(orders.where(F.col("status") != "Cancelled"), paid, "order_id")
    if rule.rule_id == "QR033":
        return existing(cancelled, paid, "order_id")
    raise ValueError(f"no row form for {rule.rule_id}: {rule.check}")


class Source(NamedTuple):
    """Where the violating rows of a rule come from, if other tables decide which they are."""

    table: str  # whose rows they are, their columns first
    condition: str | None  # that all of them meet
    references: dict[str, str]  # deciding table -> the key it is asked by, named alike in `table`


SET_SOURCES = {
    "return_without_line": Source("returns", None, {"order_items": "order_id"}),
    "unverified_review": Source("product_reviews", "verified_purchase", {"orders": "customer_id", "order_items": "product_id"}),
    "return_date_out_of_order": Source("returns", None, {"orders": "order_id"}),
}
LEDGER_SOURCES = {
    "QR029": Source("shipments", None, {"orders": "order_id"}),
    "QR031": Source("orders", "status = 'Returned'", {"returns": "order_id"}),
    "QR032": Source("orders", "status <> 'Cancelled'", {"payments": "order_id"}),
    "QR033": Source("orders", "status = 'Cancelled'", {"payments": "order_id"}),
}


def _source(rule: Rule) -> Source | None:
    kind, text = _kind(rule)
    if kind == "header":
        return Source("orders", None, {"order_items": "order_id"})
    if kind == "unique":
        return Source(rule.dataset, None, {rule.dataset: text})
    if kind == "not_in":
        key, reference = text.split()
        return Source(rule.dataset, None, {reference: key})
    if kind == "rows":
        return SET_SOURCES.get(text)
    return LEDGER_SOURCES.get(rule.rule_id) if kind == "ledger" else None


def _json(columns: Sequence[str]) -> Column:
    return F.to_json(F.struct(*[F.col("`" + c.replace("`", "``") + "`") for c in columns]))


def _row_text(rows: DataFrame) -> DataFrame:
    return rows.select(F.substring(F.to_json(F.struct("*")), 1, SAMPLE_CHARS).alias("failing_value"))


def _smallest(texts: DataFrame, n: int) -> list[str]:
    name = texts.columns[0]
    return [r[0] for r in texts.orderBy(name).limit(n).collect()]


def smallest_texts(spark: SparkSession, t: Tables, rule: Rule, as_of: dt.date, n: int, tried: int = CANDIDATES) -> list[str]:
    """The first `n` texts of a rule's violating rows, in their order.

    Where other tables decide, whole rows are not shuffled to find out. A row's lead, the text of its first columns without
    the closing brace, starts the text of the violating row, so a row whose lead lies beyond n found texts cannot come
    before them. The keys of the rows with the smallest leads are tried first, against the rows of the deciding tables
    that have these keys. If too few of them violate the rule, all rows are looked through by their keys and leads; this
    gives a bound for the leads of the sampled rows.
    """
    source = _source(rule)
    if source is None:
        return _smallest(_row_text(violating_rows(t, rule, as_of)), n)
    table, keys = t[source.table], list(dict.fromkeys(source.references.values()))
    # joins move their keys to the front; the columns of the table come first in any case
    order = violating_rows(t, rule, as_of).columns[: len(table.columns)]
    keyed, text = reduce(Column.__and__, [F.col(key).isNotNull() for key in keys]), _json(order)
    if set(order[: len(keys)]) == set(keys):  # few columns, so that a join behind the table moves no others
        text = F.when(keyed, _json(order[: len(keys)])).otherwise(_json(order[: len(keys) + 1]))

    def with_lead(chars: int) -> DataFrame:
        return table.withColumn(LEAD, F.substring(F.rtrim(text, F.lit("}")), 1, chars))

    def asked(chars: int) -> DataFrame:
        return with_lead(chars).where(source.condition) if source.condition else with_lead(chars)

    def decided(few, last: str) -> list[str]:
        """The first texts among all rows that have one of the keys given in the driver, of rows without a key up to a lead."""
        among = {}
        for key in keys:
            values = few[key].unique().to_pylist()
            values += [-v for v in values if isinstance(v, float) and v == 0]  # equal in joins, but not in long lists
            # a filter instead of a join, since it reaches the scans of any view
            among[key] = F.col(key).isin([v for v in values if v is not None])
            if None in values:
                among[key] |= F.col(key).isNull()
        tables = {name: t[name].where(among[key]) for name, key in source.references.items()}
        rows = with_lead(chars).where(reduce(Column.__and__, among.values()))
        tables[source.table] = rows.where(keyed | (F.col(LEAD) <= last)).drop(LEAD)
        return _smallest(_row_text(violating_rows(ChainMap(tables, t), rule, as_of)), n)

    chars = SAMPLE_CHARS
    first = asked(chars).select(*keys, LEAD).orderBy(LEAD).limit(tried).toArrow()
    leads = sorted(first[LEAD].to_pylist())
    if not leads:
        return []
    texts = decided(first, leads[-1])
    if len(leads) < tried:
        return texts
    if len(texts) == n:
        if texts[-1] <= leads[-1]:  # every row that was not tried has the last lead or a greater one
            return texts
        bound = texts[-1]
    else:
        chars = min(chars, len(commonprefix([leads[0], leads[-1]])) + 16)
        found = _smallest(violating_rows(ChainMap({source.table: with_lead(chars)}, t), rule, as_of).select(LEAD), n)
        if not found:
            return []
        bound = found[-1]
    while True:
        below = F.col(LEAD) <= bound
        few = asked(chars).where(below).select(*keys).distinct().limit(tried + 1).toArrow()
        if few.num_rows <= tried:
            texts = decided(few, bound)
        else:
            rows = violating_rows(ChainMap({source.table: with_lead(chars)}, t), rule, as_of)
            texts = _smallest(_row_text(rows.where(below).drop(LEAD)), n)
        if len(texts) < n or texts[-1][:chars] <= bound:
            return texts
        bound = texts[-1][:chars]


def failure_samples(
    spark: SparkSession, t: Tables, results: DataFrame, as_of: dt.date, at: dt.datetime,
    rules: Sequence[Rule] = RULES, per_rule: int = SAMPLES_PER_RULE,
) -> DataFrame:
    """A few violating rows of every failed rule, as JSON text; the same rows every time.

    The rules are looked through one after another, so that their shuffles do not lie on disk together.
    """
    by_id = {r.rule_id: r for r in rules}
    failed = results.where((F.col("status") == "FAIL") & (F.col("failed_records") > 0)).select("rule_id", "run_id")
    found = []
    with freed_shuffles(spark):
        for rule_id, run_id in sorted(map(tuple, failed.collect())):  # at most one row per rule
            rule = by_id[rule_id]
            try:
                violating_rows(t, rule, as_of)
            except ValueError:  # no row form
                continue
            texts = smallest_texts(spark, t, rule, as_of, per_rule)
            found += [(rule_id, rule.dataset, rule.field, text, run_id) for text in texts]
    samples = spark.createDataFrame(found, "rule_id string, dataset string, field string, failing_value string, run_id string")
    return samples.select(
        F.concat("rule_id", F.lit("_"), "run_id", F.lit("_"), F.substring(F.sha2("failing_value", 256), 1, 12)).alias("sample_id"),
        "rule_id", "dataset", "field", "failing_value", "run_id", F.lit(at).alias("captured_at"),
    )


def blocking(results: DataFrame) -> DataFrame:
    """Results that stop a run: a critical or error rule that failed or could not be evaluated."""
    return results.where(F.col("severity").isin("critical", "error") & F.col("status").isin("FAIL", "ERROR"))


def gate(results: DataFrame) -> None:
    """Raise if anything blocks. Call it after the summaries are written."""
    rows = blocking(results).orderBy("rule_id").collect()  # at most one row per rule
    if rows:
        critical = sum(r.severity == "critical" for r in rows)
        listed = "; ".join(f"{r.rule_id} {r.status} ({r.failed_records} rows, {r.failure_pct}%)" for r in rows)
        raise QualityGateError(f"{critical} critical and {len(rows) - critical} error rules block the run: {listed}")


def quality_summary(results: DataFrame) -> DataFrame:
    n = F.count(F.lit(1))
    by = {s: F.count_if(F.col("status") == s) for s in ("PASS", "FAIL", "ERROR")}
    return results.groupBy("severity").agg(
        n.alias("rule_count"), by["PASS"].alias("passed"), by["FAIL"].alias("failed"), by["ERROR"].alias("errors"),
        m.pct(by["PASS"], n, 1).alias("pass_rate_pct"),
    )


def data_quality_kpi(summary: DataFrame, as_of: dt.date) -> DataFrame:
    return summary.agg(
        F.sum("rule_count").alias("total_rules"), F.sum("passed").alias("total_passed"),
        F.sum("failed").alias("total_failed"), F.sum("errors").alias("total_errors"),
        m.pct(F.sum("passed"), F.sum("rule_count"), 1).alias("overall_pass_rate_pct"),
    ).select(F.lit(as_of).alias("report_date"), "*")


def run_status(results: DataFrame) -> DataFrame:
    return results.agg(
        F.when(F.count_if(F.col("status") == "ERROR") > 0, "FAILED").otherwise("SUCCEEDED").alias("status"),
        F.count(F.lit(1)).alias("rows_written"),
    )


