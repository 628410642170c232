"""Query modules; importing one registers its queries in joulebox.registry."""
