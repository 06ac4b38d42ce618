import pyarrow.parquet as pq
import pytest

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def documents():
    """(doc_id, text) of the smallest table."""
    t = pq.read_table(f"{SF_SMALL}/documents.parquet", columns=["doc_id", "text"])
    return list(zip(t["doc_id"].to_pylist(), t["text"].to_pylist()))
