"""``python -m dailybars ...`` runs the report job (see ``plans.job``)."""

from .plans.job import main

main()
