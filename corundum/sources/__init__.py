"""Reading and writing the domain tables, and the identity of their sources."""
