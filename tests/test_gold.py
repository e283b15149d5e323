from __future__ import annotations

import random
import re
from collections import Counter

import pytest
from conftest import rows
from pyspark.sql import functions as F
from shop import D1, D2, good_feeds, item, paid, tender, transaction

from retailgold.operators import gold
from retailgold.operators.typed import type_feeds
from retailgold.schemas import GOLD_TABLES, conform, gold_layout


def typed(feed, **feeds):
    return type_feeds({n: feed(n, r) for n, r in feeds.items()})


def test_typing(feed):
    bad = transaction(store="x")
    bad.update(DateCreated="01/02/2020", RegisterNumber=None, postransactionnumber=None, SourceTransactionNumber=None)
    out = typed(feed, transactions=[bad, transaction(store="12.9")])["transactions"]
    assert rows(out, "SourceOrganizationNumber", "DateCreated", "sourcetransactionnumber", "registernumber")[0] == (
        None, None, "", "")
    assert {r[0] for r in rows(out, "SourceOrganizationNumber")} == {None, 12}
    kinds = {f.name.lower(): f.dataType.simpleString() for f in out.schema}
    assert (kinds["sourceorganizationnumber"], kinds["datecreated"]) == ("int", "date")


def test_transactions_check_id_is_never_null(feed):
    gone = dict(transaction(), SourceTransactionNumber=None, postransactionnumber=None, RegisterNumber=None)
    out = gold.transactions(typed(feed, transactions=[gone, transaction("9")]))
    assert rows(out, "check_id", "partition_col") == [("9~55~07", D1), ("~~", D1)]


def test_line_item_keys(feed):
    feeds = typed(
        feed,
        transactions=[transaction("1"), transaction("1", dt=D2, pos="66"), transaction("1", "11", pos="77")],
        transaction_item=[
            item("1", "a"), item("1", "b", dt=D2), item("1", "c", "11"), item("2", "no match"), item(None, "null key"),
            item("1", "no store", None),
        ],
    )
    assert rows(gold.line_item(feeds), "sourcetransactionitemnumber", "check_id") == [
        ("a", "1~55~07"), ("b", "1~66~07"), ("c", "1~77~07")
    ]


def test_unknown_feed_columns_pass_through(feed):
    feeds = typed(feed, transactions=[transaction()], transaction_item=[item()])
    feeds["transaction_item"] = feeds["transaction_item"].withColumn("brand_new", F.lit("n"))
    assert gold.line_item(feeds).first().brand_new == "n"


def names_for(feed, tenders, settlement, transactions=None):
    feeds = typed(feed, transactions=transactions or [transaction()], tenders=tenders, settlement=settlement)
    return [r[0] for r in rows(gold.tenders(feeds), "customer_name")]


def test_tender_name_lookup(feed):
    assert names_for(feed, [tender()], [paid()]) == ["Ann"]
    for other in (
        paid(store="11"), paid(register="8"), paid(when="01/03/2020"), paid(card="411111xxxxxx9999"),
        paid(card="422222xxxxxx1234"), paid(amount="10.51"), paid(register="x"), paid(card=None), paid(amount="x"),
    ):
        assert names_for(feed, [tender()], [other]) == [None]


def test_tender_smallest_name_and_hidden_digits(feed):
    assert names_for(feed, [tender()], [paid(name="Zoe"), paid(name="Ann"), paid(name=None)]) == ["Ann"]
    # another mask or another spelling of the register is another group: one row each
    assert names_for(feed, [tender()], [paid(), paid(name="Bob", card="411111******1234")]) == ["Ann", "Bob"]
    assert names_for(feed, [tender()], [paid(), paid(name="Bob", register="07")]) == ["Ann", "Bob"]


def test_tenders_that_cannot_match_stay(feed):
    # an empty card part on both sides is no match; an empty text is a value
    assert names_for(feed, [tender(card=None)], [paid(card=None)]) == [None]
    assert names_for(feed, [tender(card="")], [paid(card="")]) == ["Ann"]
    assert names_for(feed, [tender()], [paid()], [transaction(register=None)]) == [None]
    assert names_for(feed, [tender(amount="x")], [paid(amount="y")]) == [None]


def test_discounts(feed):
    feeds = typed(
        feed,
        transactions=[transaction("1"), transaction("2")],
        transaction_item=[item("1", "1-1"), item("2", "2-1"), item("1", "none"), item(None, "lost")],
        trans_disc_xref=[
            dict(SourceTransactionItemNumber=n, DiscountCode=c, DiscountAmt="1", dt=d)
            for n, c, d in (("1-1", "A", D1), ("2-1", "B", D1), ("2-1", "?", D1), ("lost", "A", D1), ("1-1", "A", D2))
        ],
        discounts=[
            dict(discountcode=c, discountdescription=t, discounttype="PCT", dt=D1)
            for c, t in (("A", "one"), ("A", "one"), ("B", "two"), ("B", "zwei"))
        ],
    )
    want = [("1-1", "A", "one", "1~55~07", D1), ("2-1", "B", "two", "2~55~07", D1), ("2-1", "B", "zwei", "2~55~07", D1)]
    columns = ("SourceTransactionItemNumber", "DiscountCode", "DiscountDescription", "check_id", "partition_col")
    assert rows(gold.discounts(feeds), *columns) == want
    assert rows(gold.discounts(feeds, line_items=gold.line_item(feeds)), *columns) == want


def test_product(feed):
    def goods(number, category, day="2020-01-01", dt=D1):
        return dict(SourceProductNumber=number, SourceProductCategoryNumber=category, DateCreated=day, dt=dt)

    feeds = typed(
        feed,
        product=[goods("a", "k"), goods("b", "none"), goods("c", "k", dt=D2), goods("d", "k", "2020-01-05"), goods("e", None)],
        product_category=[dict(SourceCategoryNumber="k", Name="Care", DateCreated="2020-01-01", dt=D1)],
    )
    assert rows(gold.product(feeds), "SourceProductNumber", "Sourceproductcategoryname") == [("a", "Care")]


def test_every_table_meets_its_contract(feed):
    feeds = type_feeds(good_feeds(feed))
    for table in GOLD_TABLES:
        out = conform(gold.BUILDERS[table](feeds), table)
        assert out.columns == gold_layout(table).names
        assert [f.dataType for f in out.schema] == [f.dataType for f in gold_layout(table)]


# --- one key with a third of all rows ------------------------------------------------------------------------------------

@pytest.fixture
def split_early(conf):
    """Make AQE see small partitions as hot, as it would large ones on a cluster."""
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.shuffle.partitions", "8")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "8KB")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "1.5")
    conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "8KB")
    # small stages keep several map outputs, which is what a hot partition is split along
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")


def final_plan(df):
    plan = df._jdf.queryExecution().executedPlan()
    return plan.toString()


def test_hot_transaction_is_split(feed, split_early):
    random.seed(1)
    numbers = [str(random.randrange(400)) for _ in range(6000)] + ["7"] * 3000
    feeds = typed(
        feed, transactions=[transaction(str(n), pos=f"p{n}") for n in range(400)],
        transaction_item=[item(n, f"{n}-{i}") for i, n in enumerate(numbers)],
    )
    out = gold.line_item(feeds)
    got = Counter(r.check_id for r in out.collect())
    assert got == Counter(f"{n}~p{n}~07" for n in numbers)
    assert "skew=true" in final_plan(out)


def test_hot_card_is_split(feed, split_early):
    """A third of the tenders has one store, day, amount and card, all in the settlement file."""
    n = 6000
    cards = [0 if i % 3 == 0 else i for i in range(n)]
    feeds = typed(
        feed, transactions=[transaction(str(i)) for i in range(n)],
        tenders=[tender(str(i), amount="5", card=f"411111xxxxxx{c:04d}", tendercode=f"code {i}") for i, c in enumerate(cards)],
        settlement=[paid(card=f"411111xxxxxx{c:04d}", amount="5", name=f"n{c}") for c in set(cards)],
    )
    out = gold.tenders(feeds)
    assert {r.sourcetransactionnumber: r.customer_name for r in out.collect()} == {
        str(i): f"n{c}" for i, c in enumerate(cards)
    }
    assert re.search(r"SortMergeJoin\(skew=true\).*LeftOuter", final_plan(out))


def test_hot_item_is_split(feed, split_early):
    """A third of the discount references names one item."""
    numbers = ["i0" if i % 3 == 0 else f"i{i}" for i in range(6000)]
    feeds = typed(
        feed, transactions=[transaction("1")], transaction_item=[item("1", n) for n in sorted(set(numbers))],
        trans_disc_xref=[
            dict(SourceTransactionItemNumber=n, DiscountCode="A", DiscountAmt=str(i), dt=D1) for i, n in enumerate(numbers)
        ],
        discounts=[dict(discountcode="A", discountdescription="one", discounttype="PCT", dt=D1)],
    )
    out = gold.discounts(feeds)
    got = Counter((r.SourceTransactionItemNumber, r.DiscountAmt) for r in out.collect())
    assert got == Counter((n, str(i)) for i, n in enumerate(numbers))
    assert "skew=true" in final_plan(out)


def test_tenders_without_card_spread(feed, split_early):
    """A third of all tenders is cash of one store, day and amount: the outer join gets them in all partitions."""
    n = 3000
    feeds = typed(
        feed,
        transactions=[transaction(str(i)) for i in range(n)],
        tenders=[tender(str(i), amount="5", card=None if i % 3 == 0 else f"411111xxxxxx{i:04d}") for i in range(n)],
        settlement=[paid(card=f"411111xxxxxx{i:04d}", amount="5", name=f"n{i}") for i in range(n) if i % 3],
    )
    out = gold.tenders(feeds)
    named = {r.sourcetransactionnumber: r.customer_name for r in out.collect()}
    assert named == {str(i): f"n{i}" if i % 3 else None for i in range(n)}
    cash = out.filter("accountnumbermasked is null")
    per_task = cash.groupBy(F.spark_partition_id()).count().collect()
    assert len(per_task) > 1 and max(r["count"] for r in per_task) < n / 3
