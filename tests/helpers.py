"""Shared by the tests: results in a form that two engines can be compared in."""

SMALL = "/root/testdata/sf0.001"


def plain(value):
    """A value as text that doesn't depend on the engine's number types."""
    if isinstance(value, bool) or value is None or isinstance(value, str):
        return str(value)
    if isinstance(value, (list, tuple)):
        return str([plain(x) for x in value])
    if isinstance(value, (bytes, bytearray)):
        return bytes(value).hex()
    return f"{float(value):.9g}"


def table(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(tuple(plain(r[i]) for i in order) for r in rows)
