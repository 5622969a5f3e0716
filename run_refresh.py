"""spark-submit entry for the refresh job (ship the package with --py-files)."""

from fishladder.plans.refresh import main

if __name__ == "__main__":
    main()
