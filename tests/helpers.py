"""Small frames for edge cases."""

from datetime import datetime
from decimal import Decimal

EVENT = ("event_id string, eventTimeStamp timestamp, date_id date, userId string, eventType string, "
         "subscriptionId string, packageId string, eggToken bigint, chatToken bigint, totalCostThb decimal(18,6), "
         "aiModel string")


def events(spark, *rows):
    """Rows of (event_id, 'day hh:mm', user, type, subscription, package, tokens[, cost])."""
    out = []
    for event_id, at, user, kind, sub, package, egg, *cost in rows:
        ts = datetime.fromisoformat(f"2024-01-{at}:00+00:00")
        out.append((event_id, ts, ts.date(), user, kind, sub, package, egg, None,
                    Decimal(cost[0]) if cost else Decimal(0), None))
    return spark.createDataFrame(out, EVENT)


def packages(spark, *rows):
    return spark.createDataFrame([(i, n, Decimal(p)) for i, n, p in rows],
                                 "packageId bigint, packageName string, priceThb decimal(18,2)")


def b2c_packages(spark):
    return packages(spark, (1, "Starter", 259), (2, "Standard", 499), (3, "Pro", 999), (12, "Free Trial", 0))


def users(spark, *banned):
    return spark.createDataFrame([(u, flag) for u, flag in banned], "userId string, isBanned boolean")


def rows(frame, *columns):
    frame = frame.select(*columns) if columns else frame
    return sorted((tuple(r) for r in frame.collect()), key=lambda r: tuple(map(str, r)))
