"""What the tests of several files share; its name clashes with no ``conftest``."""

from __future__ import annotations

from datetime import datetime

START = datetime(2024, 1, 1)


def column(df, name, order="datetime"):
    return [row[name] for row in df.orderBy(order).select(name).collect()]
