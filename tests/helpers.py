import datetime as dt


def d(text):
    return dt.date.fromisoformat(text)


def epoch(text):
    return int(dt.datetime.fromisoformat(text).replace(tzinfo=dt.timezone.utc).timestamp())


def order(row):
    return [(x is None, str(x)) for x in row]


def rows(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=order)
