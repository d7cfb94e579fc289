import datetime as dt

UTC = dt.timezone.utc
START = dt.datetime(2024, 1, 1, tzinfo=UTC)
HALF_HOUR = dt.timedelta(minutes=30)


def period(i):
    return START + i * HALF_HOUR


def naive(i):
    """A period as collect() gives it back: in the process's own zone, here compared as epoch."""
    return period(i).timestamp()


def epochs(rows, column="settlement_period"):
    return [r[column].timestamp() for r in rows]
