import json

import pytest

from shelfmark.session import build_session

PAGE_SCHEMA = "page_url string, page int, html string"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g"},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def page(**props) -> str:
    """A page with the given parts of page state."""
    state = json.dumps({"props": {"pageProps": props}})
    return f'<html><body><script id="__NEXT_DATA__" type="application/json">\n{state}\n</script></body></html>'


def page_table(spark, *pages: str):
    rows = [("https://books.example.org/b/reviews", i + 1, html) for i, html in enumerate(pages)]
    return spark.createDataFrame(rows, PAGE_SCHEMA)
