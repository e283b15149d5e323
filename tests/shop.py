"""A small shop: two dates, two stores, every table reconciles."""

D1, D2 = 20200102, 20200103
DAY = {D1: "2020-01-02", D2: "2020-01-03"}


def transaction(number="1", store="10", dt=D1, register="07", pos="55", **more):
    return dict(
        SourceTransactionNumber=number, SourceOrganizationNumber=store, DateCreated=DAY[dt], RegisterNumber=register,
        postransactionnumber=pos, TransactionTimeStamp=DAY[dt] + " 10:00:00", SourceCustomerNumber="c" + str(number),
        Currency="USD", dt=dt, **more,
    )


def tender(number="1", store="10", dt=D1, amount="10.5", card="411111xxxxxx1234", **more):
    return dict(
        sourcetransactionnumber=number, sourceorganizationnumber=store, transactiondate=DAY[dt], tenderamt=amount,
        accountnumbermasked=card, tendername="CARD" if card else "CASH", dt=dt, **more,
    )


def item(number="1", line="1-1", store="10", dt=D1, **more):
    return dict(
        sourcetransactionitemnumber=line, sourcetransactionnumber=number, sourceorganizationnumber=store,
        datecreated=DAY[dt], sourceproductnumber="p1", dt=dt, **more,
    )


def paid(store="10", when="01/02/2020 10:00:00", name="Ann", card="411111xxxxxx1234", amount="10.50", register="7"):
    return dict(
        store_id=store, store_transaction_date_time=when, customer_name=name, masked_card_number=card,
        approved_amount=amount, pos_register_number=register,
    )


def good_feeds(feed):
    """Raw feeds that pass every check."""
    return {
        "transactions": feed("transactions", [transaction("1"), transaction("2", "11"), transaction("3", dt=D2)]),
        "tenders": feed("tenders", [tender("1"), tender("2", "11", card=None), tender("3", dt=D2, amount="7")]),
        "transaction_item": feed("transaction_item", [item("1"), item("2", "2-1", "11"), item("3", "3-1", dt=D2)]),
        "trans_disc_xref": feed("trans_disc_xref", [
            dict(SourceTransactionItemNumber="1-1", DiscountCode="D1", DiscountAmt="1", dt=D1),
            dict(SourceTransactionItemNumber="3-1", DiscountCode="D1", DiscountAmt="2", dt=D2),
        ]),
        "discounts": feed("discounts", [
            dict(discountcode="D1", discountdescription="one", discounttype="PCT", dt=d) for d in (D1, D2, D1)
        ]),
        "product": feed("product", [
            dict(SourceProductNumber="p1", Name="Soap", SourceProductCategoryNumber="k1", DateCreated="2020-01-01", dt=D1),
        ]),
        "product_category": feed("product_category", [
            dict(SourceCategoryNumber="k1", Name="Care", DateCreated="2020-01-01", dt=D1),
        ]),
        "organization": feed("organization", [dict(SourceOrganizationNumberkey="10", Name="Main St", dt=D1)]),
        "settlement": feed("settlement", [paid(), paid(when="01/03/2020 11:00:00", amount="7", name="Bob")]),
    }
