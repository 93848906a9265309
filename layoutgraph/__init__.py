"""layoutgraph: document-structure and entity-graph analytics as plain PySpark DataFrame plans."""
