"""``python -m visitflow silver|gold|gold-live|kpi|report``."""

import sys

from visitflow.plans.jobs import main

sys.exit(main())
