import duckdb
import pytest

from checks import compare
from tripweave.llm import quotes
from tripweave.llm.oracles import ORACLES
from tripweave.llm.queries import registered


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_agrees_with_sql(spark, sf_dir, sql, name):
    assert compare.difference(registered()[name](spark, sf_dir), sql, ORACLES[name]) is None


def test_quotes_agree_with_sql_where_there_are_some(spark):
    said = ["the first thing to say", "quite another thing, in two lines\nand this is the second", "yes", "a last word on this"]
    rows = []
    for conv in range(6):
        for turn in range(8):
            own = said[(conv * 3 + turn * turn) % 4]
            quoted = said[(conv + turn) % 4].replace("\n", "\n> ")
            deeper = said[(conv * turn) % 4].replace("\n", "\n>> ")
            text = {0: own, 1: f"> {quoted}\n{own}", 2: f">> {deeper}\n> {quoted}\n\n{own}", 3: f"> > {deeper}\r\n{own}\r\n>{quoted}"}[(conv + 2 * turn) % 4]
            rows.append((conv, turn, "user", text))
    rows += [(None, 1, "user", "> " + said[0]), (1, None, "user", "> " + said[0]), (2, 3, "user", "> " + said[0]), (2, 3, "user", None), rows[9]]
    conversations = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    result = quotes.op5_quote_links(conversations)
    assert result.where("n_linked > 0").count() > 10
    # The join of the SQL lists a repeated row once for each of its kind and place, as the query does.
    assert compare.difference(result, con, ORACLES["op5_quote_links"]) is None
