"""Searches stay in the JVM until a row is known to match, and move nothing."""

from courier.functions.words import Tokenizer, strip_plural
from courier.operators import text as X
from courier.plans.inputs import table


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_match_moves_nothing(spark):
    documents = table(spark, "/root/testdata/sf0.001", "documents")
    for query, tokenizer in (("the and", X.PLAIN), ("th*", X.PLAIN), ("las", Tokenizer(strip_plural))):
        text = plan(X.match(documents, ["text"], query, tokenizer))
        assert "Exchange" not in text and "Python" not in text


def test_offsets_are_measured_in_the_jvm_for_matching_rows(spark):
    pages = table(spark, "/root/testdata/sf0.001", "pages")
    text = plan(X.match_offsets(pages, "page_id", ["url", "html"], "example nich*"))
    assert "Python" not in text and "Exchange" not in text
    measured, scan = text.index("octet_length"), text.index("FileScan")
    assert "array_contains" in text[measured:scan]
