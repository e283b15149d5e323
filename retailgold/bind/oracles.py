"""The same results as DuckDB SQL over the star-schema tables.

Every text starts from the common table expressions it needs; these restate the feeds, typed, with lower-case names.
"""

from __future__ import annotations

import re

from retailgold.schemas import FEED_COLUMNS, GOLD_COLUMNS, GOLD_TABLES, POS_FEEDS

_DT = "cast(year(o_orderdate) * 10000 + month(o_orderdate) * 100 + 1 as integer)"
_DAY = "strftime(o_orderdate, '%Y-%m-%d')"
_STORE = "cast(o_custkey % 100 as integer)"
_REG = "lpad(cast(o_orderkey % 12 as varchar), 2, '0')"
_ITEM = "l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey || '-' || copy"
_CODE = "'D' || cast(cast(round(l_discount * 100) as integer) as varchar)"
_PRE = "'4' || lpad(cast(o_custkey % 100000 as varchar), 5, '0')"
_SUF = "lpad(cast(o_orderkey % 10000 as varchar), 4, '0')"
_LINES = """(select *, row_number() over (partition by l_orderkey, l_linenumber, l_partkey, l_suppkey order by l_discount) as copy
        from lineitem) l join orders on l_orderkey = o_orderkey"""
_FOLDERS = {"click": "brand_a/daily/", "view": "brand_b/daily/", "purchase": "brand_a/weekly/", "signup": "brand_b/weekly/"}
_DIMS = "('product', 'product_category', 'organization')"

_FEED_LIST = "[" + ", ".join(f"'{f}'" for f in POS_FEEDS) + "]"

CTES = {
    # feeds
    "raw_tx": f"""select cast(o_orderkey as varchar) as number, {_STORE} as store, {_DAY} as day,
        cast(o_custkey as varchar) as customer, {_DAY} || ' 10:00:00' as stamp,
        case when o_orderkey % 101 <> 0 then {_REG} end as register,
        case when o_orderkey % 97 <> 0 then cast(o_custkey as varchar) end as pos, {_DT} as dt from orders""",
    "tx": """select number, store, day, customer, stamp, coalesce(register, '') as register, coalesce(pos, '') as pos, dt
        from raw_tx""",
    "full_item": f"""select {_ITEM} as item_no, cast(l_orderkey as varchar) as number, {_STORE} as store,
        cast(l_partkey as varchar) as product, {_DAY} as day, {_DT} as dt, l_discount, l_orderkey from {_LINES}""",
    "item": """select item_no, case when l_orderkey % 89 <> 0 then number end as number, store, product, day, dt
        from full_item""",
    "tender": f"""select cast(o_orderkey as varchar) as number, {_STORE} as store, {_DAY} as day,
        case when o_orderkey % 4 = 0 then 'CASH' else 'CARD' end as name, cast(o_totalprice as varchar) as amount_text,
        o_totalprice as amount, case when o_orderkey % 4 <> 0 then {_PRE} || 'xxxxxx' || {_SUF} end as card, {_DT} as dt
        from orders""",
    "paid": f"""select {_STORE} as store, cast(o_orderdate as date) as day,
        strftime(o_orderdate, '%m/%d/%Y') || ' 10:00:00' as stamp, c_name, o_totalprice as amount,
        cast(o_totalprice as varchar) as amount_text, cast(o_orderkey % 12 as varchar) as register, {_PRE} as pre,
        {_SUF} as suf, o_orderkey from orders join customer on o_custkey = c_custkey
        where o_orderkey % 4 <> 0 and o_orderkey % 7 <> 0""",
    "settled": """select store, day, stamp, c_name as name, pre || 'xxxxxx' || suf as card, amount, amount_text, register from paid
        union all select store, day, stamp, 'ZZ ' || c_name, pre || 'xxxxxx' || suf, amount, amount_text, register from paid
        where o_orderkey % 11 = 0
        union all select store, day, stamp, c_name, pre || '******' || suf, amount, amount_text, register from paid
        where o_orderkey % 13 = 0""",
    "xref": f"""select {_ITEM} as item_no, {_CODE} as code, cast(l_discount as varchar) as amount, {_DT} as dt
        from {_LINES} where l_discount > 0""",
    "codes": f"""select distinct {_CODE} as code, {_CODE} || ' percent' as description, 'PCT' as kind, {_DT} as dt
        from {_LINES} where l_discount > 0""",
    "stores": """select cast(s_suppkey as varchar) as number, s_name as name, n_name as state, r_name as country, 19950101 as dt
        from supplier join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey""",
    "goods": """select cast(p_partkey as varchar) as number, p_name as name, p_brand as brand,
        cast(p_size as varchar) as size, p_type as category, '1995-01-01' as day, 19950101 as dt from part""",
    "cats": """select distinct p_type as number, 'Category ' || p_type as name, '1995-01-01' as day, 19950101 as dt from part""",
    # gold
    "g_tx": "select *, number || '~' || pos || '~' || register as check_id from tx",
    "g_item": """select i.*, i.number || '~' || t.pos || '~' || t.register as check_id, t.stamp from item i join tx t
        on i.dt = t.dt and i.number = t.number and i.store = t.store and i.day = t.day""",
    "g_full_item": """select i.*, i.number || '~' || t.pos || '~' || t.register as check_id, t.stamp from full_item i
        join tx t on i.dt = t.dt and i.number = t.number and i.store = t.store and i.day = t.day""",
    "sold": """select d.*, t.customer, t.register, t.stamp, d.number || '~' || t.pos || '~' || t.register as check_id
        from tender d join tx t on d.dt = t.dt and d.number = t.number and d.store = t.store and d.day = t.day""",
    "names": """select store, day, card, amount, register, min(name) as customer_name from settled
        group by store, day, card, amount, register""",
    "g_tender": """select s.*, n.customer_name from sold s left join names n on n.store = s.store
        and cast(n.register as integer) = try_cast(nullif(s.register, '') as integer)
        and n.day = cast(s.day as date) and right(n.card, 4) = right(s.card, 4) and left(n.card, 6) = left(s.card, 6)
        and n.amount = s.amount""",
    "g_discount": """select g.*, x.code, x.amount, c.kind, c.description from xref x
        join g_item g on x.dt = g.dt and x.item_no = g.item_no join codes c on c.dt = x.dt and c.code = x.code""",
    "g_product": """select p.*, c.name as category_name from goods p join cats c
        on p.dt = c.dt and p.category = c.number and p.day = c.day""",
    # arrivals
    "keys": f"""select event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') as event_time, event_type, day, feed,
        case when feed in {_DIMS} and event_type in ('purchase', 'signup')
             then case event_type when 'purchase' then 'brand_a' else 'brand_b' end || '/weekly_staging/' || feed || '/dt=' || day
             else case event_type {" ".join(f"when '{k}' then '{v}'" for k, v in _FOLDERS.items())} else 'other/logs/' end || feed
             end || '/feed_' || feed || '_' || day || '.psv.gz' as key,
        event_id as size, event_type <> 'error' as relevant,
        case when event_type in ('view', 'signup') then 'brand_b' else 'brand_a' end as brand,
        case when event_type in ('click', 'view') then 'daily' when event_type in ('purchase', 'signup') then 'weekly' end
            as schedule,
        case when feed in {_DIMS} and event_type in ('purchase', 'signup') then 'staged' else 'remote' end as place,
        cast(day as integer) as dt
        from (select *, ({_FEED_LIST})[user_id % 8 + 1] as feed, strftime(ts, '%Y%m%d') as day from events) e""",
    "paid_days": """select distinct cast(strftime(ts, '%Y%m%d') as integer) as dt from events where day(ts) % 7 <> 0""",
    "per_feed": f"""select k.brand, k.schedule, k.dt, f.feed, bool_or(k.feed = f.feed) as seen
        from keys k cross join (select unnest({_FEED_LIST}) as feed) f
        where k.relevant group by k.brand, k.schedule, k.dt, f.feed""",
    "complete": f"""select p.brand, p.schedule, p.dt,
        coalesce(string_agg(p.feed, ',' order by list_position({_FEED_LIST}, p.feed)) filter (where not p.seen), '')
            as missing,
        bool_or(d.dt is not null) as has_settlement
        from per_feed p left join paid_days d on p.dt = d.dt group by p.brand, p.schedule, p.dt""",
}


def _sql(body: str) -> str:
    """The text with all common table expressions it uses, in order."""
    needed: set[str] = set()

    def collect(text: str) -> None:
        for name in CTES:
            if name not in needed and re.search(rf"\b{name}\b", text):
                needed.add(name)
                collect(CTES[name])

    collect(body)
    ctes = ",\n".join(f"{n} as ({CTES[n]})" for n in CTES if n in needed)
    return f"with {ctes}\n{body}" if ctes else body


def _cols(names: str, typed: str = "", **given: str) -> str:
    """A select list over all names; those not given are NULL text."""
    return ", ".join(f"{given.get(n.lower(), 'cast(null as varchar)')} as {n.lower()}" for n in names.split())


# gold select lists
_TX = dict(
    sourcetransactionnumber="number", sourceorganizationnumber="store", currency="'USD'", transactiontimestamp="stamp",
    sourcecustomernumber="customer", datecreated="day", registernumber="register", postransactionnumber="pos", dt="dt",
)
_ITEMS = dict(
    sourcetransactionitemnumber="item_no", sourcetransactionnumber="number", sourceorganizationnumber="store",
    sourceproductnumber="product", datecreated="day", dt="dt",
)
_TENDER = dict(
    sourcecustomernumber="customer", registernumber="register", transactiontimestamp="stamp", currency="'USD'",
    check_id="check_id", sourcetransactionnumber="number", sourceorganizationnumber="store", transactiondate="day",
    tendername="name", tenderamt="amount", accountnumbermasked="card", dt="dt",
)
_ORG = dict(sourceorganizationnumberkey="number", name="name", state="state", country="country", dt="dt")
_PROD = dict(
    sourceproductnumber="number", name="name", brandname="brand", size="size", sourceproductcategorynumber="category",
    datecreated="day", dt="dt",
)
_CAT = dict(sourcecategorynumber="number", name="name", datecreated="day", dt="dt")
_DISC = dict(
    datecreated="day", sourcetransactionnumber="number", sourcetransactionitemnumber="item_no",
    sourceorganizationnumber="store", sourceproductnumber="product", discountcode="code", discountamt="amount",
    discounttype="kind", discountdescription="description", check_id="check_id", dt="dt",
)


def _gold(table: str, source: str, given: dict[str, str], **more: str) -> str:
    columns = _cols(GOLD_COLUMNS[table], **given, **more)
    return f"select {columns}, dt as partition_col from {source}"


def _without(names: str, *gone: str) -> str:
    return " ".join(n for n in names.split() if n.lower() not in gone)


_GOLD_TX = _gold("transactions", "g_tx", _TX, check_id="check_id")
_GOLD_ITEM = _gold("transaction_item", "g_item", _ITEMS, check_id="check_id", transactiontimestamp="stamp")
_GOLD_TENDER = _gold("tenders", "g_tender", _TENDER, customer_name="customer_name")
_GOLD_ORG = _gold("organization", "stores", _ORG)
_GOLD_CAT = _gold("product_category", "cats", _CAT)

_GOLD_SOURCES = {
    "transactions": "g_tx", "product_category": "cats", "product": "g_product", "organization": "stores",
    "tenders": "g_tender", "transaction_item": "g_item", "discounts": "g_discount",
}
_STAGED_SOURCES = {
    "transactions": "tx", "product_category": "cats", "product": "goods", "organization": "stores",
    "tenders": "tender", "transaction_item": "item", "discounts": "xref",
}
_COUNTS = " union all ".join(
    f"select '{t}' as entity_type, (select count(*) from {_STAGED_SOURCES[t]}) as source_count, "
    f"(select count(*) from {_GOLD_SOURCES[t]}) as destination_count" for t in GOLD_TABLES
)
_RATIO = "(count(distinct customer_name) + max(case when customer_name is null then 1 else 0 end)) / cast(count(*) as double)"
_RESULTS = f"""select c.*, case when destination_count = 0 then 'FAILURE'
    when entity_type = 'tenders' then case when source_count = destination_count
        and (select {_RATIO} from g_tender) > 0.2 then 'SUCCESS' else 'WARNING' end
    when source_count = destination_count then 'SUCCESS' else 'FAILURE' end as event_result from ({_COUNTS}) c"""
_AUDIT = f"""select 'brand_a' as brand_sid, 'gold_run' as event_type, 'pos' as data_category,
    '2024-01-31' as ingestion_date, entity_type, source_count, destination_count, event_result, 'daily' as note_schedule
    from ({_RESULTS}) r"""
_ORDER = "case entity_type " + " ".join(f"when '{t}' then {i}" for i, t in enumerate(GOLD_TABLES)) + " end"
_DISTINCT = "count(distinct {0}) + max(case when {0} is null then 1 else 0 end)"


def _pick(key: str, *options: str) -> str:
    cases = " ".join(f"when {i} then {o}" for i, o in enumerate(options))
    return f"case {key} % {len(options)} {cases} end"


_ISO = "strftime({}, '%Y-%m-%d')"
_SETTLE_TEXT = _pick(
    "o_orderkey", "strftime(o_orderdate, '%m/%d/%Y %H:%M:%S')", "strftime(o_orderdate, '%-m/%-d/%Y %H:%M')",
    "strftime(o_orderdate, '%-m/%d/%Y')", _ISO.format("o_orderdate"), "'garbage'", "'13/45/2020 10:00'", "null",
)
_NUMBER_TEXT = _pick(
    "l_suppkey", "cast(l_partkey as varchar)", "' 00' || l_partkey || ' '", "cast(l_extendedprice as varchar)",
    "'-' || l_partkey", "'x' || l_partkey", "l_partkey || '00000000000'", "''", "null", "'+' || l_partkey || '.'",
)
_DATE_TEXT = _pick(
    "l_suppkey", _ISO.format("l_shipdate"), "strftime(l_shipdate, '%Y-%m-%d %H:%M:%S')", "strftime(l_shipdate, '%m/%d/%Y')",
    "''", "'2020-13-01'", "null",
)
_CARD_TEXT = _pick("cast(number as bigint)", "card", "left(card, 5)", "left(card, 3)", "''")
_LINE_KEY = "l_orderkey, l_linenumber, l_partkey"
_XREF_ITEM = "xref x join item i on x.dt = i.dt and x.item_no = i.item_no"


def _name(table: str, schedule: str) -> str:
    if schedule == "weekly":
        first = "'20240201'"
    else:
        first = "strftime(strptime(cast(dt as varchar), '%Y%m%d') - interval 1 day, '%Y%m%d')"
    return f"'{table}_' || {first} || '_' || dt || '_{schedule}.psv.gz'"


_SCANNED_ITEM = _cols(
    FEED_COLUMNS["transaction_item"] + " dt", **{**_ITEMS, "sourceorganizationnumber": "cast(store as varchar)"}
)
_SETTLEMENT = dict(
    store_id="cast(store as varchar)", store_transaction_date_time="stamp", customer_name="name",
    masked_card_number="card", approved_amount="amount_text", pos_register_number="register",
)

_MONTHS = "(select dt, row_number() over (order by dt) - 1 as place, count(*) over () as months from (select distinct dt from tx)) m"

ORACLES = {
    "scan_feed_psv": f"select {_SCANNED_ITEM} from item",
    "scan_settlement_glob": f"select {_cols(FEED_COLUMNS['settlement'], **_SETTLEMENT)} from settled",
    "scan_partitioned_dt": 'select dt, count(*) as "rows" from tx group by dt',
    "scan_gold_readback": _GOLD_ITEM,
    "sql_surface_view": """select t.dt, d.name as tendername, count(*) as tenders, max(d.amount) as largest
        from tender d join tx t on t.dt = d.dt and t.number = d.number group by t.dt, d.name""",
    "catalog_external_table":
        "select item_no as sourcetransactionitemnumber, code as discountcode, amount as discountamt, dt from xref",
    "catalog_gold": 'select dt as partition_col, count(*) as "rows", min(check_id) as first_check_id from g_tx group by dt',
    "catalog_history": """select 'transactions' as entity_type, dt, count(*) as "rows", min(check_id) as first_check_id, max(check_id) as last_check_id
        from g_tx group by dt union all select 'transaction_item', dt, count(*), min(check_id), max(check_id) from g_item group by dt""",
    "catalog_sync_partitions": """select dt as partition_col, count(*) as "rows", 1 as added, 1 as dropped from g_tx
        where dt >= 19950201 and dt <> 19960201 group by dt""",
    "catalog_archive": 'select dt, count(*) as "rows", max(amount_text) as largest from tender group by dt',
    "catalog_settlement": """select cast(strftime(day, '%Y%m01') as integer) as file_dt, count(*) as "rows",
        count(distinct day) as days from settled group by file_dt""",
    "type_settlement": """select store as store_id, name as customer_name, card as masked_card_number,
        amount as approved_amount, register as pos_register_number from settled""",
    "type_transactions": f"select {_cols(_without(GOLD_COLUMNS['transactions'], 'check_id'), **_TX)} from tx",
    "type_line_items":
        f"select {_cols(_without(GOLD_COLUMNS['transaction_item'], 'check_id', 'transactiontimestamp'), **_ITEMS)} from item",
    "type_tenders": f"""select {_cols(FEED_COLUMNS['tenders'] + ' dt', **{
        k: v for k, v in _TENDER.items() if k not in ('sourcecustomernumber', 'registernumber')})} from tender""",
    "gold_organization": _GOLD_ORG,
    "gold_product_category": _GOLD_CAT,
    "conform_contract": _GOLD_ORG,
    "gold_transactions": _GOLD_TX,
    "filter_missing_key": f"select {_SCANNED_ITEM} from item where number is null or number = ''",
    "filter_start_date": f"""select {_cols(FEED_COLUMNS['transactions'] + ' dt', **{
        **_TX, 'sourceorganizationnumber': 'cast(store as varchar)'})} from raw_tx where dt > 19960101""",
    "join_tender_transaction":
        f"select {_cols(_without(GOLD_COLUMNS['tenders'], 'customer_name'), **_TENDER)} from sold",
    "gold_tenders": _GOLD_TENDER,
    "gold_line_item": _GOLD_ITEM,
    "gold_line_item_bucketed": _GOLD_ITEM,
    "gold_discounts_bucketed": _gold("discounts", "g_discount", _DISC),
    "join_tender_transaction_bucketed":
        f"select {_cols(_without(GOLD_COLUMNS['tenders'], 'customer_name'), **_TENDER)} from sold",
    "join_xref_item": f"""select x.item_no as sourcetransactionitemnumber, x.code as discountcode, x.amount as discountamt, x.dt,
        i.number as sourcetransactionnumber, i.product as sourceproductnumber from {_XREF_ITEM}""",
    "gold_discounts": _gold("discounts", "g_discount", _DISC),
    "gold_product": _gold("product", "g_product", _PROD, sourceproductcategoryname="category_name"),
    "gold_tenders_two_brands":
        f"select g.*, case when sourceorganizationnumber % 2 = 0 then 'brand_a' else 'brand_b' end as brand from ({_GOLD_TENDER}) g",
    "agg_settlement_summary": """select store as store_id, cast(day as varchar) as settlement_day, card as masked_card_number,
        amount as approved_amount, register as pos_register_number, customer_name from names""",
    "agg_settlement_incremental": """select store as store_id, cast(day as varchar) as settlement_day, card as masked_card_number,
        amount as approved_amount, register as pos_register_number, customer_name from names""",
    "distinct_discount_dim":
        "select distinct code as discountcode, description as discountdescription, kind as discounttype, dt from codes",
    "count_rows": " union all ".join(
        f"select '{feed}' as feed, count(*) as \"rows\" from {source}" for feed, source in {
            "transactions": "tx", "tenders": "tender", "transaction_item": "item", "trans_disc_xref": "xref",
            "product": "goods", "product_category": "cats", "organization": "stores", "settlement": "settled",
        }.items()
    ) + """ union all select 'discounts' as feed, count(*) + count(*) filter (where code = 'D5') as "rows" from codes""",
    "count_distinct_nullable": " union all ".join(
        f"select '{label}' as column_name, {_DISTINCT.format(column)} as distinct_values from {source}"
        for label, column, source in (
            ("customer_name", "customer_name", "g_tender"), ("accountnumbermasked", "card", "tender"),
            ("tendername", "name", "tender"),
        )
    ),
    "count_per_dt": 'select dt, count(*) as "rows" from item group by dt',
    "fn_check_id": """select number as sourcetransactionnumber, number || '~' || pos || '~' || register as plain,
        number || '~' || coalesce(pos, '') || '~' || coalesce(register, '') as filled from raw_tx""",
    "fn_coalesce_key": """select number as sourcetransactionnumber, case when register is null then '' else register end as register,
        case when pos is null then '' else pos end as pos_number from raw_tx""",
    "fn_settlement_date": f"""select o_orderkey, cast(cast(try_strptime(
        nullif(regexp_extract({_SETTLE_TEXT}, '^[0-9]+/[0-9]+/[0-9]+'), ''), '%m/%d/%Y') as date) as varchar) as day from orders""",
    "fn_card_suffix": f"select number, right({_CARD_TEXT}, 4) as suffix from tender",
    "fn_card_prefix": f"select number, left({_CARD_TEXT}, 6) as prefix from tender",
    "fn_lenient_int": f"""select {_LINE_KEY}, text,
        cast(try_cast(trunc(try_cast(trim(text) as double)) as integer) as varchar) as value
        from (select *, {_NUMBER_TEXT} as text from lineitem) l""",
    "fn_lenient_double": f"""select {_LINE_KEY}, text, try_cast(trim(text) as double) as value
        from (select *, {_NUMBER_TEXT} as text from lineitem) l""",
    "fn_lenient_date": f"""select {_LINE_KEY}, cast(try_cast(left(text, 10) as date) as varchar) as day
        from (select *, {_DATE_TEXT} as text from lineitem) l""",
    "fn_date_from_name": "select event_id, day from keys",
    "fn_feed_folder": """select event_id, feed, array_to_string(list_transform(string_split(feed, '_'),
        lambda w: upper(w[1]) || w[2:]), '_') as folder from keys""",
    "sink_gold_psv": f"""select * replace (nullif(postransactionnumber, '') as postransactionnumber,
        nullif(registernumber, '') as registernumber) from ({_GOLD_TX}) g""",
    "sink_one_file_per_dt": "select dt, cast(1 as bigint) as files from (select distinct dt from tx) d",
    "gold_file_names": " union all ".join(
        f"""select '{table}' as entity_type, dt, {_name(public, schedule)} as file_name, '{schedule}' as schedule
        from (select distinct dt from {source}) {table}_{schedule}"""
        for table, public, source in (
            ("transactions", "transactions", "tx"), ("transaction_item", "line_item", "g_item"),
            ("organization", "organization", "stores"),
        ) for schedule in ("daily", "weekly")
    ),
    "publish_gold": f"""select dt, count(*) as "rows", min(check_id) as first_check_id, max(check_id) as last_check_id,
        replace({_name('line_item', 'daily')}, '.psv.gz', '_p0001.psv.gz') as file_name from g_item group by dt""",
    "publish_large_date": """select dt, cast(ceil(count(*) / 100.0) as bigint) as files, count(*) as "rows",
        least(count(*), 100) as largest, least(count(*), 100) as smallest_but_last from tx group by dt""",
    "publish_crash_between_tables": " union all ".join(
        f"""select 'transactions' as entity_type, dt, '{money}' as currency, count(*) as "rows", '{state}' as state from g_tx group by dt
        union all select 'transaction_item', dt, null, count(*), '{state}' from g_item group by dt"""
        for state, money in (("crashed", "USD"), ("finished", "EUR"))
    ),
    "rerun_date_emptied": """select dt, count(*) as "rows" from g_tx where dt <> 19960301 group by dt""",
    "stage_incremental": f"""select strftime(day, '%Y%m01') as file, count(*) as "rows", strftime(day, '%Y') >= '1997' as second
        from settled group by all""",
    "scan_feed_header_drift": """select number as sourcetransactionnumber, register as registernumber,
        case when dt // 10000 % 3 = 1 then 'new' end as newcol, day as datecreated, dt from tx""",
    "scan_feed_two_headers": """select number as sourcetransactionnumber, register as registernumber,
        case when cast(number as bigint) % 2 = 1 then 'new' end as newcol, day as datecreated, dt from tx""",
    "scan_feed_rejects": """select dt, count(*) filter (where cast(number as bigint) % 50 > 1) as "rows",
        count(*) filter (where cast(number as bigint) % 50 <= 1) as rejected, count(*) filter (where cast(number as bigint) % 50 = 0) as longer
        from raw_tx group by dt""",
    "scan_gold_readback_drift": """select number as sourcetransactionnumber, check_id, case when dt < 19960101 then 'red' end as colour,
        case when dt >= 19960101 then 'P' end as promo, dt as partition_col from g_tx""",
    "scan_settlement_header_drift": """select cast(store as varchar) as store_id, name as customer_name, card as masked_card_number,
        case when month(day) % 2 = 0 then 'new' end as newcol, cast(strftime(day, '%Y%m01') as integer) as file_dt from settled""",
    "rerun_date_idempotent": """select number as sourcetransactionnumber,
        case when dt between 19960101 and 19961231 then 'EUR' else 'USD' end as currency, check_id, dt from g_tx""",
    "sink_audit_log": _AUDIT,
    "archive_feed": """select 'tenders' as feed, cast(dt as varchar) as part, card, amount_text as amount from tender
        union all select 'settlement', strftime(day, '%Y%m01'), card, amount_text from settled""",
    "carry_over_dimensions": """select 'product' as feed, name, dt from goods union all
        select 'product_category', name, dt from cats union all select 'organization', name, dt from stores""",
    "dq_reconcile": _RESULTS,
    "dq_reconcile_by_date": """select 'transactions' as entity_type, count(*) as source_count, count(*) as destination_count,
        cast(2 as bigint) as dates_differing, 'row counts of 2 dates differ from staging' as reason, 'FAILURE' as event_result from tx""",
    "dq_name_gate_success": """select count(*) as source_count, count(*) as destination_count,
        count(distinct number) as distinct_names, 'SUCCESS' as event_result from tender""",
    "dq_mandatory_fields": """select 'transactions' as entity_type, count(*) as destination_count,
            count(*) filter (where pos is null or register is null) as missing_check_id, cast(0 as bigint) as missing_timestamp
            from raw_tx
        union all select 'tenders', count(*), count(*) filter (where raw_tx.pos is null or raw_tx.register is null), 0
            from g_tender join raw_tx using (dt, number, store, day)
        union all select 'transaction_item', count(*), count(*) filter (where raw_tx.pos is null or raw_tx.register is null), 0
            from g_item join raw_tx using (dt, number, store, day)
        union all select 'discounts', count(*), count(*) filter (where raw_tx.pos is null or raw_tx.register is null), 0
            from g_discount join raw_tx using (dt, number, store, day)""",
    "dq_tender_match_rate": f"""select (select count(*) from tender) as source_count, count(*) as destination_count,
        {_DISTINCT.format('customer_name')} as distinct_names, {_RATIO} as name_ratio,
        case when {_RATIO} > 0.2 and count(*) = (select count(*) from tender) then 'SUCCESS' else 'WARNING' end as event_result
        from g_tender""",
    "dq_counts_by_date": """select dt, coalesce(g.n, 0) as gold_rows, coalesce(s.n, 0) as staging_rows,
        coalesce(g.n, 0) - coalesce(s.n, 0) as difference
        from (select dt, count(*) as n from g_item group by dt) g
        full join (select dt, count(*) as n from item group by dt) s using (dt)""",
    "dq_fingerprint_by_date": """select dt, count(*) as gold_rows, count(*) as staging_rows, dt // 100 % 2 = 0 or count(*) = 1 as same
        from full_item group by dt""",
    "dq_differing_rows": """select dt, item_no as sourcetransactionitemnumber, case when item_no = low then 2 else 0 end::bigint as gold_rows,
        cast(1 as bigint) as staging_rows from full_item join (select dt, min(item_no) as low, max(item_no) as high from full_item group by dt) e using (dt)
        where low <> high and item_no in (low, high)""",
    "dq_zero_rows": """select 'product' as entity_type, count(*) as source_count, cast(0 as bigint) as destination_count,
        'zero rows; row count 0 differs from staging row count ' || count(*) as reason, 'FAILURE' as event_result from goods""",
    "audit_rows": _AUDIT,
    "dq_gate": f"""select entity_type, source_count, destination_count, event_result from ({_RESULTS}) r
        where {_ORDER} <= (select min({_ORDER}) from ({_RESULTS}) f where event_result = 'FAILURE')""",
    "run_daily": " union all ".join(
        f"select '{t}' as entity_type, dt, count(*) as \"rows\" from {source} group by dt"
        for t, source in {**_GOLD_SOURCES, "transaction_item": "g_full_item", "discounts":
            "(select x.dt from xref x join g_full_item g on x.dt = g.dt and x.item_no = g.item_no) d"}.items()
    ),
    "run_weekly": " union all ".join(
        f"select '{t}' as entity_type, dt, count(*) as \"rows\" from {source} where dt in (19950101, 19960201) group by dt"
        for t, source in {**_GOLD_SOURCES, "transaction_item": "g_full_item", "discounts":
            "(select x.dt from xref x join g_full_item g on x.dt = g.dt and x.item_no = g.item_no) d"}.items()
    ),
    "run_manifest": " union all ".join(
        f"""select '{t}' as entity_type, dt, cast(1 as integer) as part,
        replace({_name(public, 'daily')}, '.psv.gz', '_p0001.psv.gz') as file_name from (select distinct dt from {source}) m_{t}"""
        for t, public, source in (("transactions", "transactions", "tx"), ("transaction_item", "line_item", "g_full_item"))
    ),
    "run_manifest_two_runs": " union all ".join(
        f"""select '{t}' as entity_type, dt, cast(1 as integer) as part,
        '{public}_{first}_' || dt || '_weekly_p0001.psv.gz' as file_name from (select distinct dt from {source} where {dates}) m_{t}_{first}"""
        for t, public, source, first, dates in (
            ("transactions", "transactions", "tx", "20240201", "dt < 19951201 and dt >= 19950101"),
            ("transactions", "transactions", "tx", "20240208", "dt between 19951201 and 19960201"),
            ("transaction_item", "line_item", "g_full_item", "20240201", "dt between 19950101 and 19951201"),
        )
    ),
    "arrivals_parse": "select event_time, 'landing' as bucket, key, size from keys",
    "arrivals_malformed": """select case event_id % 10 when 3 then 'no records' when 4 then 'records without a key' else 'no text' end as reason,
        count(*) as notifications, case when event_id % 10 = 4 then count(*) end as records from keys where event_id % 10 in (3, 4, 5)
        group by event_id % 10""",
    "arrivals_relevant": "select event_id, key from keys where relevant",
    "arrivals_classify": "select event_id, key, brand, schedule, place from keys",
    "arrivals_feed_date": "select event_id, 'feed_' || feed || '_' || day || '.psv.gz' as file_name, feed, dt from keys",
    "arrivals_ready": "select brand, schedule, dt from complete where missing = '' and has_settlement",
    "arrivals_missing": "select * from complete where missing <> '' or not has_settlement",
    "arrivals_pending": """select key, feed, dt, size from keys where relevant and brand = 'brand_a'
        and (feed, dt) not in (select (feed, dt) from keys where relevant and brand = 'brand_b'
            and dt in (select dt from paid_days))""",
    "select_dates": """select number as sourcetransactionnumber, dt, '19950301' as spec from tx where dt = 19950301
        union all select number, dt, '19950101,19960201,19990101' from tx where dt in (19950101, 19960201, 19990101)
        union all select number, dt, '19951101:19960201' from tx where dt in (19951101, 19951201, 19960101, 19960201)""",
    "select_files_by_date":
        "select event_id, 'feed_' || feed || '_' || day || '.psv.gz' as name, feed from keys where day = '20240115'",
    "stream_arrivals": "select key, size, brand, schedule, place, feed, dt from keys where relevant",
    "stream_ready_dates": "select brand, schedule, dt from complete where missing = '' and has_settlement",
    "stream_overdue_dates": "select brand, schedule, dt, missing, has_settlement from complete where missing <> '' or not has_settlement",
    "stream_ready_late_settlement": "select brand, schedule, dt from complete where missing = '' and has_settlement",
    "stream_gold_rejects_date": """select dt, count(*) as "rows", false as rejected from g_full_item
        where dt // 100 % 100 <> 7 and dt <> 19960301 group by dt
        union all select 19960301, 0, true""",
    "stream_gold_all_tables": " union all ".join(
        f"""select '{t}' as entity_type, dt, count(*) as "rows" from {source} where dt // 100 % 100 <> 7 and dt <> 19960301 group by dt"""
        for t, source in {**_GOLD_SOURCES, "transaction_item": "g_full_item", "discounts":
            "(select x.dt from xref x join g_full_item g on x.dt = g.dt and x.item_no = g.item_no) d",
            "product_category": f"(select m.dt from cats cross join {_MONTHS})", "organization": f"(select m.dt from stores cross join {_MONTHS})",
            "product": f"(select m.dt from goods g join {_MONTHS} on cast(g.number as bigint) % m.months = m.place)"}.items()
    ) + " union all select 'transaction_item', 19960301, null",
    "stream_gold_line_item": _gold(
        "transaction_item", "g_full_item where dt // 100 % 100 <> 7", _ITEMS, check_id="check_id",
        transactiontimestamp="stamp",
    ),
}


def all_oracles() -> dict[str, str]:
    return {name: _sql(body) for name, body in ORACLES.items()}
