"""Entry point for spark-submit; see ``racestream.cli``."""

from racestream.cli import main

if __name__ == "__main__":
    main()
