import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from touchline.session import get_session
    s = get_session(master="local[4]", shuffle_partitions=8)
    yield s


def rows(df, cols=None, digits=6):
    """Rows as sorted tuples with rounded floats (order-insensitive comparison)."""
    pdf = df.toPandas()
    if cols:
        pdf = pdf[cols]
    out = []
    for r in pdf.itertuples(index=False, name=None):
        out.append(tuple(round(v, digits) if isinstance(v, float) and v == v else (None if isinstance(v, float) else v) for v in r))
    return sorted(out, key=repr)
