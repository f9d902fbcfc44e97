"""``python -m viewgrid run|test|build`` -- see viewgrid.plans.runner."""

import sys

from viewgrid.plans.runner import main

sys.exit(main())
