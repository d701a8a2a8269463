"""Entry file for spark-submit."""

from salesflow.cli import main

if __name__ == "__main__":
    main()
