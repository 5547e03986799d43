"""python -m caravel translate FILE | check FILE | query FOLDER SQL"""

from __future__ import annotations

import sys
from pathlib import Path


def main(args: list[str]) -> int:
    if len(args) >= 2 and args[0] == "translate":
        from .engine import translate_file

        print(translate_file(args[1]))
        return 0
    if len(args) >= 2 and args[0] in ("check", "query"):
        from .config import setup_logging
        from .plans.relational import use_tables
        from .script import run
        from .session import session

        setup_logging()
        spark = session()
        if args[0] == "check":
            results = run.check(spark, Path(args[1]).read_text(encoding="utf-8"), args[1])
            run.report(spark, results).show(truncate=False)
            return int(not all(r.ok for r in results))
        from .dialect import translate_query

        text = translate_query(args[2])
        use_tables(spark, args[1], text)
        spark.sql(text).show(50, truncate=False)
        return 0
    print(__doc__)
    return 2


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
