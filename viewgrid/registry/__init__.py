"""Query registry: ``QUERIES`` (name -> fn(spark, sf_dir)) and ``ORACLES``
(name -> DuckDB SQL over the driver tables).  Importing this package imports
every registry module, which registers its entries."""

from viewgrid.registry.base import ORACLES, QUERIES  # noqa: F401
from viewgrid.registry import models  # noqa: F401,E402
from viewgrid.registry import ops  # noqa: F401,E402
from viewgrid.registry import analytics  # noqa: F401,E402
from viewgrid.registry import io  # noqa: F401,E402
from viewgrid.registry import quality  # noqa: F401,E402
from viewgrid.registry import audience  # noqa: F401,E402
