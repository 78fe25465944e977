"""Table builders of the layers. Builders take and return DataFrames; paths appear only in ``lake``."""
