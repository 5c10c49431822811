"""The quality rules as plain rows.

A rule's `check` names what counts as a violation:

    where:  <boolean SQL over the dataset's columns, `:as_of` allowed>
    unique: <key>
    not_in: <key> <reference table>
    header: <boolean SQL over orders joined to their line totals (cents: `line_gross`, `line_discounts`)>
    ledger: <violations per order_id, over the columns of `quality.order_ledger`>
    rows:   <name of a set check in `quality.SET_CHECKS`>
    sql:    <a SELECT that returns one count, over temporary views>
"""

from __future__ import annotations

from typing import NamedTuple


class Rule(NamedTuple):
    rule_id: str
    dataset: str
    field: str
    rule_type: str
    severity: str
    threshold: float  # allowed failures in percent of the dataset's rows
    check: str
    description: str
    enabled: bool = True


# Rule ids, targets, severities and thresholds.
RULES: tuple[Rule, ...] = (
    Rule("QR001", "customers", "customer_id", "uniqueness", "critical", 0.0,
         "unique: customer_id", "customer ids are unique"),
    Rule("QR002", "customers", "email", "completeness", "error", 1.0,
         "where: email IS NULL OR trim(email) = ''", "an email is given"),
    Rule("QR003", "customers", "email", "validity", "warning", 5.0,
         "where: NOT (email LIKE '%@%.%')", "emails look like addresses"),
    Rule("QR004", "customers", "registration_date", "validity", "error", 0.0,
         "where: try_cast(registration_date AS date) > :as_of", "nobody registered in the future"),
    Rule("QR005", "orders", "customer_id", "referential_integrity", "critical", 0.0,
         "not_in: customer_id customers", "orders belong to known customers"),
    Rule("QR006", "orders", "order_total", "validity", "error", 0.0,
         "where: order_total <= 0", "gross totals are positive"),
    Rule("QR007", "orders", "order_date", "timeliness", "error", 0.0,
         "where: try_cast(order_date AS date) > :as_of", "no order is dated in the future"),
    Rule("QR008", "order_items", "quantity", "validity", "error", 0.0,
         "where: quantity <= 0", "quantities are positive"),
    Rule("QR009", "order_items", "unit_price", "validity", "error", 0.0,
         "where: unit_price <= 0", "item prices are positive"),
    Rule("QR010", "payments", "amount", "validity", "error", 0.0,
         "where: amount <= 0", "amounts are positive"),
    Rule("QR011", "payments", "order_id", "referential_integrity", "critical", 0.0,
         "not_in: order_id orders", "payments belong to known orders"),
    Rule("QR012", "products", "product_id", "uniqueness", "critical", 0.0,
         "unique: product_id", "product ids are unique"),
    Rule("QR013", "products", "price", "validity", "error", 0.0,
         "where: price <= 0", "product prices are positive"),
    Rule("QR014", "inventory_events", "quantity", "validity", "informational", 0.0,
         "where: quantity = 0", "stock movements move something"),
    Rule("QR015", "shipments", "order_id", "referential_integrity", "error", 0.0,
         "not_in: order_id orders", "shipments belong to known orders"),
    Rule("QR016", "clickstream_events", "session_id", "completeness", "warning", 2.0,
         "where: session_id IS NULL OR trim(session_id) = ''", "clicks carry a session"),
    Rule("QR017", "support_tickets", "customer_id", "referential_integrity", "error", 0.0,
         "not_in: customer_id customers", "tickets belong to known customers"),
    Rule("QR018", "returns", "order_id", "referential_integrity", "error", 0.0,
         "not_in: order_id orders", "returns belong to known orders"),
    Rule("QR019", "customers", "customer_segment", "validity", "warning", 5.0,
         "where: customer_segment NOT IN ('Basic', 'Standard', 'Premium', 'VIP')", "segments are known"),
    Rule("QR020", "orders", "status", "validity", "warning", 2.0,
         "where: status NOT IN ('Processing', 'Shipped', 'Completed', 'Cancelled', 'Returned')",
         "order states are known"),
    Rule("QR021", "products", "category_id", "referential_integrity", "warning", 0.0,
         "not_in: category_id categories", "products belong to known categories"),
    Rule("QR022", "shipments", "status", "validity", "warning", 2.0,
         "where: status NOT IN ('Processing', 'In Transit', 'Delivered', 'Failed')", "shipment states are known"),
    Rule("QR023", "payments", "status", "validity", "warning", 2.0,
         "where: status NOT IN ('Completed', 'Failed', 'Refunded')", "payment states are known"),
    Rule("QR024", "customers", "country", "validity", "warning", 5.0,
         "where: length(country) <> 2", "countries are two-letter codes"),
    Rule("QR025", "orders", "order_total", "consistency", "error", 0.0,
         "header: coalesce(abs(try_cast(order_total AS decimal(30,6)) * 100 - line_gross) > 1, order_total IS NOT NULL)",
         "header totals equal the sum of the lines"),
    Rule("QR026", "orders", "discount_amount", "consistency", "error", 0.0,
         "header: coalesce(abs(try_cast(discount_amount AS decimal(30,6)) * 100 - line_discounts) > 1, discount_amount IS NOT NULL)",
         "header discounts equal the line discounts"),
    Rule("QR027", "orders", "tax_amount", "consistency", "error", 0.0,
         "where: coalesce(abs(try_cast(tax_amount AS decimal(30,6)) - round((try_cast(order_total AS decimal(30,6))"
         " - try_cast(discount_amount AS decimal(30,6))) * 0.08, 2)) > 0.01,"
         " tax_amount + order_total + discount_amount IS NOT NULL)",
         "tax is 8% of gross less discount"),
    Rule("QR028", "returns", "product_id", "referential_integrity", "critical", 0.0,
         "rows: return_without_line", "returned products were on the order"),
    Rule("QR029", "shipments", "order_id", "consistency", "error", 0.0,
         "ledger: CASE WHEN order_id IS NOT NULL THEN shipments * cancelled END", "cancelled orders are not shipped"),
    Rule("QR030", "product_reviews", "verified_purchase", "referential_integrity", "error", 0.0,
         "rows: unverified_review", "verified reviews have a purchase behind them"),
    Rule("QR031", "orders", "status", "consistency", "critical", 0.0,
         "ledger: CASE WHEN order_id IS NULL OR approved = 0 THEN returned END",
         "returned orders have an approved return"),
    Rule("QR032", "payments", "status", "consistency", "error", 0.0,
         "ledger: CASE WHEN order_id IS NULL OR paid = 0 THEN live END", "live orders are paid"),
    Rule("QR033", "payments", "status", "consistency", "error", 0.0,
         "ledger: CASE WHEN order_id IS NOT NULL AND paid > 0 THEN cancelled END", "cancelled orders are not paid"),
    Rule("QR034", "inventory_events", "quantity", "consistency", "error", 0.0,
         "rows: negative_stock", "stock never ends below zero"),
    Rule("QR035", "shipments", "actual_delivery", "consistency", "error", 0.0,
         "where: actual_delivery IS NOT NULL AND (try_cast(actual_delivery AS date) < try_cast(ship_date AS date)"
         " OR try_cast(actual_delivery AS date) > :as_of)", "deliveries follow shipping and are in the past"),
    Rule("QR036", "returns", "return_date", "consistency", "error", 0.0,
         "rows: return_date_out_of_order", "returns follow the order and are in the past"),
)
