"""Random search of one model family with a ledger; call it again to go on where the last call ended.

Usage: python scripts/search.py forest|boosting|ridge LEDGER [sf_dir] [most_fits]
Prints the finished maps, best first.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from arrivo import get_spark  # noqa: E402
from arrivo.operators import model  # noqa: E402
from arrivo.plans.queries_model import feature_lists, model_table  # noqa: E402


def main() -> None:
    kind, ledger = sys.argv[1:3]
    sf_dir = sys.argv[3] if len(sys.argv) > 3 else "/root/testdata/sf0.01"
    most = int(sys.argv[4]) if len(sys.argv) > 4 else None
    spark = get_spark("local[8]")
    table = model_table(spark, sf_dir)
    res = model.random_search(table.filter(F.col("split") == "train"), *feature_lists(table), kind, ledger=ledger, most_fits=most)
    print(f"{res.count()} of {len(model.draw_params(kind))} maps finished")
    res.show(100, truncate=False)


if __name__ == "__main__":
    main()
