"""The SQL of licence recognition against the operator, on texts harder than the given documents."""

import random

import duckdb
import pandas as pd
import pytest

from tablework.llm import licences
from tests.llm import test_operators as given

PIECES = [given.MIT_TEXT, given.APACHE_TEXT, given.GPL_TEXT, given.BSD_TEXT, "All rights reserved.", "© 2019 Foo GmbH", "Copyright (C) 2001 Foo. All rights reserved.",
          "This project is\nlicensed under the MIT License.", "Released under the MIT License; see below.", "Some rights reserved; none granted.", "1. This is licensed to you",
          "* Star item: permission", "* small star with warranty", "plain prose without any of it", "", "---", "Licensed under CC BY 4.0.\n\n\nLicensed under CC BY-NC 4.0.",
          "See the License for the specific language\n# governing permissions and limitations\n# under the License.", "Warranty?! None: ask.\nPermission: no", "A table was reserved (c) in 2001."]


@pytest.mark.parametrize("sign", ["", "# ", " * ", "// "])
def test_sql_reads_as_the_operator_does(spark, sign):
    draw = random.Random(len(sign))
    texts = [draw.choice(["\n", " ", "\n\n", "\n" + sign]).join(draw.choices(PIECES, k=draw.randrange(1, 5))) for _ in range(150)] + PIECES + [None, "", "\n", "licens"]
    rows = [(i, t and "\n".join(sign + line for line in t.split("\n"))) for i, t in enumerate(texts)]
    documents = pd.DataFrame(rows, columns=["doc_id", "text"])  # noqa: F841  (read by the query)
    want = {r[0]: r[1:] for r in duckdb.sql(licences.OP3_SQL).fetchall()}
    got = licences.recognise(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    for r in got:
        assert (",".join(r["licences"]), r["n_sentences"], r["n_unknown"], r["n_unused"]) == want[r["doc_id"]], r["text"]
    assert len(got) == len(want) and sum(w[1] for w in want.values()) > 100
