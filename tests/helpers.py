import datetime as dt

from cardlake.schemas import PARSED

T0 = dt.datetime(2024, 1, 1, 12, 0, 0)


def payment(txn, amount=5.0, merchant="M1003", card="c1", sec=0.0, location="USA",
            auth="APPROVED", currency="USD"):
    ts = T0 + dt.timedelta(seconds=sec)
    amount = None if amount is None else float(amount)
    return (txn, ts.strftime("%Y-%m-%dT%H:%M:%S.%f+00:00"), card, merchant, amount, currency,
            "5411", "POS", auth, location, ts, ts.date())


def payments_df(spark, rows):
    return spark.createDataFrame(rows, PARSED)


def by_id(df, *cols):
    return {r["transaction_id"]: tuple(r[c] for c in cols) for r in df.collect()}
