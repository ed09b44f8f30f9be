"""Entry point for spark-submit."""

from declined.plans.job import main

if __name__ == "__main__":
    main()
