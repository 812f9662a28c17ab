"""Links between two blocks of items, summed up so that pairs never leave the task."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

#: What a verifying task returns: each item's number of links in these blocks (counting copies),
#: and the least item that it reaches there.
LINKS = "doc long, links long, least long"


def link_rows(link: np.ndarray, doc_a: np.ndarray, copies_a: np.ndarray, doc_b: np.ndarray, copies_b: np.ndarray, same: bool) -> pa.RecordBatch:
    """Rows of LINKS from a matrix that is true where a and b are linked; same: a and b are one block."""
    rows, columns = np.flatnonzero(link.any(axis=1)), np.flatnonzero(link.any(axis=0))
    link = link[np.ix_(rows, columns)]
    doc_a, copies_a, doc_b, copies_b = doc_a[rows], copies_a[rows], doc_b[columns], copies_b[columns]
    links_a, links_b = link @ copies_b, copies_a @ link
    least_a, least_b, big = doc_a.copy(), doc_b.copy(), np.iinfo(np.int64).max
    while len(rows):
        new_a = np.minimum(least_a, np.where(link, least_b[None, :], big).min(axis=1))
        new_b = np.minimum(least_b, np.where(link, new_a[:, None], big).min(axis=0))
        if (new_a == least_a).all() and (new_b == least_b).all():
            break
        least_a, least_b = new_a, new_b
    if not same:
        doc_a, links_a, least_a = np.concatenate((doc_a, doc_b)), np.concatenate((links_a, links_b)), np.concatenate((least_a, least_b))
    return pa.RecordBatch.from_arrays([pa.array(doc_a), pa.array(links_a.astype(np.int64)), pa.array(least_a)], names=["doc", "links", "least"])
