"""Order-free comparison of an Arrow table from Spark with one from DuckDB."""

import math


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else repr(value)
    if value is None or isinstance(value, (bool, int)):
        return value
    return str(value)


def normalised(table, columns):
    rows = zip(*[table.column(c).to_pylist() for c in columns])
    return sorted((tuple(_plain(v) for v in row) for row in rows), key=repr)


def assert_same(left, right):
    columns = sorted(left.column_names)
    assert columns == sorted(right.column_names)
    a, b = normalised(left, columns), normalised(right, columns)
    assert len(a) == len(b)
    differing = [(x, y) for x, y in zip(a, b) if x != y]
    assert not differing, differing[:2]
