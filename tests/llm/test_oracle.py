"""The SQL of the subpackage's queries on the given tables and on awkward ones."""

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from compare import connect, differences
from test_scan_repair_align import secret_texts

from stridelake.llm import oracle, queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(oracle.statements()))
def test_statements(spark, name):
    assert differences(spark, connect(SF), queries.QUERIES[name], oracle.statements()[name], SF) == []


def test_secrets_of_awkward_texts(spark, tmp_path):
    texts = secret_texts()
    pq.write_table(pa.table({"doc_id": list(range(len(texts))), "text": texts}), tmp_path / "documents.parquet")
    assert differences(spark, connect(str(tmp_path)), queries.op11_secret_scan, oracle.statements()["op11_secret_scan"], str(tmp_path)) == []


def test_repair_of_awkward_conversations(spark, tmp_path):
    import random

    rnd = random.Random(12)
    rows = [(None if c == 0 else c, None if rnd.random() < 0.1 else rnd.randint(0, 9), rnd.choice(["user", "user", "assistant", "assistant", "system", "tool", None, ""]),
             rnd.choice(["One.", "Two! ", "cut", "", None, " \x0b", "é?", "One."])) for c in range(400) for _ in range(rnd.randint(1, 9))]
    columns = dict(zip(("conv_id", "turn", "role", "text"), map(list, zip(*rows))))
    schema = pa.schema([("conv_id", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string())])
    pq.write_table(pa.table(columns, schema), tmp_path / "conversations.parquet")
    name = "op12_conversation_repair"
    assert differences(spark, connect(str(tmp_path)), queries.QUERIES[name], oracle.statements()[name], str(tmp_path)) == []
