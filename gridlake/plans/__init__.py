"""Table builders per layer (``silver``, ``gold``, ``platinum``), their lazy
composition (``medallion``) and the scheduled full refresh (``refresh``)."""
