"""Writers of the layers, the landings and the serving table."""
