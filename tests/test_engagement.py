import datetime as dt
from decimal import Decimal

from conftest import SF_SMALL, rows

from retail_insights import flatten_interactions, flatten_tickets, omni_channel
from retail_insights.schemas import CUSTOMER_SUPPORT, ENTERPRISE_CAMPAIGN
from retail_insights.sources.fixture import AS_OF, Fixture

T = dt.datetime(2024, 3, 20)
OLD = dt.datetime(2023, 1, 1)
AS = dt.date(2024, 3, 31)


def _campaigns(spark):
    return spark.createDataFrame([
        (1, "C1", (2, 1), [("i1", T, "Email", "Opened"), ("i2", T, "Email", "Clicked"),
                           ("i3", T, "Web", "Clicked"), ("i4", T, "App", "Opened"),
                           ("i5", OLD, "Email", "Opened")]),
        (2, "C1", (0, 0), None),            # NULL array: no rows
        (3, "C2", (0, 0), []),              # empty array: no rows
        (4, "C2", (1, 0), [("i6", T, "Web", "Converted")]),
    ], ENTERPRISE_CAMPAIGN)


def _support(spark):
    return spark.createDataFrame([
        (1, "t1", T, ("Open",)), (1, "t2", T, ("Resolved",)), (5, "t3", T, ("Pending",)),
        (6, "t4", OLD, ("Open",)),
    ], CUSTOMER_SUPPORT)


def _orders(spark):
    return spark.createDataFrame([
        (1, 1, T, Decimal("10.50")), (2, 7, T, Decimal("3.00")), (3, 7, T, None),
        (4, 8, OLD, Decimal("1.00")),
    ], "order_id bigint, customer_id bigint, order_date timestamp, total_amount decimal(12,2)")


def test_flatten_interactions_drops_null_and_empty(spark):
    flat = flatten_interactions(_campaigns(spark))
    assert flat.columns == ["CustomerID", "CampaignID", "Opens", "Clicks", "InteractionID",
                            "Timestamp", "Channel", "Action"]
    assert sorted(r.InteractionID for r in flat.collect()) == ["i1", "i2", "i3", "i4", "i5", "i6"]
    assert rows(flat.filter("InteractionID = 'i6'"), "CustomerID", "Opens", "Clicks") == [(4, 1, 0)]


def test_flatten_tickets_lifts_status(spark):
    t = flatten_tickets(_support(spark))
    assert t.columns == ["CustomerID", "TicketID", "Timestamp", "Issue", "Status"]
    assert rows(t, "TicketID", "Status")[0] == ("t1", "Open")


#: What an interaction counts as: (channels, action) -> place in the row of counts.
COUNTED = [({"Email"}, "Opened"), ({"Email"}, "Clicked"), ({"Web", "App"}, "Clicked"), ({"Web", "App"}, "Opened")]


def tally(inter, orders, tickets, as_of, days=90):
    """The engagement rows, counted one activity at a time in plain Python."""
    start = dt.datetime.combine(as_of, dt.time()) - dt.timedelta(days=days)
    seen = {}

    def row(customer, moment):
        if moment is not None and moment >= start:
            return seen.setdefault(customer, [0, 0, 0, 0, 0, Decimal(0), 0, 0, 0])

    for r in inter.select("CustomerID", "Timestamp", "Channel", "Action").collect():
        counts = row(r.CustomerID, r.Timestamp)
        for k, (channels, action) in enumerate(COUNTED):
            if counts and r.Channel in channels and r.Action == action:
                counts[k] += 1
    for r in orders.select("customer_id", "order_date", "total_amount").collect():
        if counts := row(r.customer_id, r.order_date):
            counts[4] += 1
            counts[5] += r.total_amount or 0
    for r in tickets.select("CustomerID", "Timestamp", "Status").collect():
        if counts := row(r.CustomerID, r.Timestamp):
            counts[6] += 1
            counts[7] += r.Status == "Open"
            counts[8] += r.Status == "Resolved"
    return sorted(((c, *counts) for c, counts in seen.items()), key=lambda t: tuple((v is None, v) for v in t))


def test_omni_channel_hand_rows(spark):
    inter = flatten_interactions(_campaigns(spark))
    tickets = flatten_tickets(_support(spark))
    orders = _orders(spark)
    out = omni_channel(inter, orders, tickets, AS, days=90)
    got = rows(out)
    assert got == tally(inter, orders, tickets, AS)
    by_id = {r[0]: r[1:] for r in got}
    # Campaign + purchase + tickets, one row; the old interaction is outside.
    assert by_id[1] == (1, 1, 1, 1, 1, Decimal("10.50"), 2, 1, 1)
    # Engagement only, with a non-counted action: present with zeros.
    assert by_id[4] == (0, 0, 0, 0, 0, Decimal("0"), 0, 0, 0)
    # Tickets only; purchases only (a NULL amount is counted, not summed).
    assert by_id[5] == (0, 0, 0, 0, 0, Decimal("0"), 1, 0, 0)
    assert by_id[7] == (0, 0, 0, 0, 2, Decimal("3.00"), 0, 0, 0)
    # Nothing in the window: absent.
    assert 6 not in by_id and 8 not in by_id and 2 not in by_id


def test_omni_channel_matches_a_tally_on_fixture(spark):
    f = Fixture(spark, SF_SMALL)
    inter = flatten_interactions(f.campaigns())
    tickets = flatten_tickets(f.support())
    out = omni_channel(inter, f.orders(), tickets, AS_OF)
    assert rows(out) == tally(inter, f.orders(), tickets, AS_OF)
