import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMOKE = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from quire.session import get_session
    s = get_session(master="local[4]", shuffle_partitions=4)
    yield s


def rows(df, order=None):
    """Collect as a list of dicts, optionally sorted."""
    out = [r.asDict(recursive=True) for r in df.collect()]
    if order:
        out.sort(key=lambda r: tuple(r[k] for k in order))
    return out


def make_elements(spark, tree_by_doc, pages=None):
    """Element rows from nested tuples ``(tag, [kids], text, page_ref, kid)``.

    Elements get ids in the given order; ``kid_pos`` counts every kid,
    including non-element ones (tag None), as in a structure tree.
    """
    out = []
    for doc_id, roots in tree_by_doc.items():
        counter = [0]

        def add(node, parent, pos):
            tag, kids, text, page_ref, kid = (list(node) + [None] * 5)[:5]
            eid = counter[0]
            counter[0] += 1
            out.append((doc_id, eid, parent, pos, tag, page_ref, kid, text))
            for i, k in enumerate(kids or []):
                add(k, eid, i)

        for i, r in enumerate(roots):
            add(r, None, i)
    from quire.schemas import ELEMENTS
    return spark.createDataFrame(out, ELEMENTS)
