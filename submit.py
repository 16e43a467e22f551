"""spark-submit entry point: ``spark-submit --py-files tillroll.zip submit.py full --lake URI``."""

from tillroll.__main__ import main

if __name__ == "__main__":
    raise SystemExit(main())
