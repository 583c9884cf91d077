"""docloom: document-structure analytics as DataFrame transformations."""
