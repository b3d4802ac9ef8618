"""For ``spark-submit submit.py <stage>``."""

from wellgauge.__main__ import main

if __name__ == "__main__":
    main()
