"""The star schema as common table expressions for the SQL oracle."""

from __future__ import annotations

from tidemart.sources import star as s


def _cols(exprs: list[str]) -> str:
    return ", ".join(exprs)


_TYPES = ", ".join(f"({k}, '{n}')" for k, n in s.PAYMENT_TYPES)
_DOCS = "(select *, (select count(*) from documents) as n_documents from orders)"

STAR = {
    "s_customers": f"select {_cols(s.CUSTOMERS)} from customer join nation "
    "on c_nationkey = n_nationkey",
    "s_sellers": f"select {_cols(s.SELLERS)} from supplier join nation "
    "on s_nationkey = n_nationkey",
    "s_products": f"select {_cols(s.PRODUCTS)} from part",
    "s_orders": f"select {_cols(s.ORDERS)} from orders",
    "s_types": f"select * from (values {_TYPES}) v(payment_type_key, payment_type)",
    "s_dates": f"select {_cols(s.DATES)}, cast(isodow(full_date) as int) as day_of_week from "
    "(select cast(unnest(generate_series(date_trunc('year', min(o_orderdate)), "
    f"date_trunc('year', max(o_orderdate) + interval {s.LATEST_DAYS} day) + interval 1 year "
    "- interval 1 day, interval 1 day)) as date) as full_date from orders)",
    "s_times": f"select {_cols(s.TIMES)}, make_timestamp(second_of_day * 1000000) as full_time "
    "from (select unnest(range(86400)) as second_of_day)",
    "s_content": f"select {_cols(s.REVIEW_CONTENT)} from documents",
    "s_items": f"select {_cols(s.ITEMS)} from lineitem left join orders on l_orderkey = o_orderkey",
    "s_payments": f"select {_cols(s.PAYMENTS)} from orders union all "
    f"select {_cols(s.SECOND_PAYMENTS)} from orders where {s.SECOND_PAYMENT_RULE}",
    "s_reviews": f"select {_cols(s.REVIEWS)} from {_DOCS} where {s.REVIEW_RULE} union all "
    f"select {_cols(s.SECOND_REVIEWS)} from {_DOCS} where {s.SECOND_REVIEW_RULE}",
}


def star_sql(body: str, **ctes: str) -> str:
    """``body`` with the named star tables and extra CTEs it mentions in front of it."""
    text = " ".join([body, *ctes.values()])
    parts = [f"{name} as ({sql})" for name, sql in STAR.items() if name in text]
    parts += [f"{name} as ({sql})" for name, sql in ctes.items()]
    return f"with {', '.join(parts)} {body}" if parts else body
