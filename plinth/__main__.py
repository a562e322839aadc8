"""``python -m plinth STORE METHOD [ARGUMENT...]``: one answer as JSON."""

from __future__ import annotations

import inspect
import json
import sys

from plinth.api import Knowledge
from plinth.session import local_session
from plinth.sources.store import Store


def typed(method, arguments: list[str]) -> list:
    """Texts as the types that the method's parameters name."""
    kinds = [p.annotation for p in list(inspect.signature(method).parameters.values())[1:]]
    read = {"int": int, "float": float, "int | None": int, "tuple": json.loads}
    return [read.get(k, str)(a) for a, k in zip(arguments, kinds, strict=False)]


def main(argv: list[str]) -> int:
    if len(argv) < 2 or argv[1].startswith("_") or not callable(getattr(Knowledge, argv[1], None)):
        print(__doc__, *sorted(n for n in vars(Knowledge) if not n.startswith("_")), sep="\n", file=sys.stderr)
        return 2
    spark = local_session(4)
    print(json.dumps(getattr(Knowledge(Store.open(spark, argv[0])), argv[1])(*typed(getattr(Knowledge, argv[1]), argv[2:])), ensure_ascii=False, default=str))
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
