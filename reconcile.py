"""Reconcile transactions between source systems; see --help."""

from tallybook.plans.jobs import main

if __name__ == "__main__":
    main()
