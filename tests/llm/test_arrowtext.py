import tracemalloc

import numpy as np
import pyarrow as pa

from tallyline.llm import arrowtext as A
from tallyline.llm.suffix_levels import _suffixes


def test_entries_of_a_batch_are_made_in_little_memory():
    letters = np.random.default_rng(3).integers(97, 123, 4 << 20, dtype=np.uint8).tobytes().decode()
    texts = [letters[at : at + 4096] for at in range(0, len(letters), 4096)]
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(len(texts))), "text": texts})
    A.powers(2)
    tracemalloc.start()
    rows = sum(b.num_rows for b in _suffixes(iter([batch])))
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows > len(texts) and most < 28e6, most
