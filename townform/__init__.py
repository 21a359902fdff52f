"""Urban form indicators for buildings, blocks and urban units, as Spark DataFrame jobs."""

from townform.params import Params

__all__ = ["Params"]
