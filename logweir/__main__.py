"""``python -m logweir <mode> [folder]`` runs a demonstration and shows its results."""

import sys

from .plans.modes import MODES
from .session import build_session, run_dir


def main(args: list[str]) -> int:
    if not args or args[0] not in MODES:
        print("modes:", ", ".join(MODES))
        return 0 if args[:1] in ([], ["help"]) else 2
    spark = build_session()
    root = args[1] if len(args) > 1 else run_dir(spark, "demo")
    for name, df in MODES[args[0]](spark, root).items():
        print(f"--- {name} (100 rows at most)")
        df.show(100, truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
