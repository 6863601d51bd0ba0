"""Entry script for spark-submit."""

from saleslake.__main__ import main

if __name__ == "__main__":
    main()
