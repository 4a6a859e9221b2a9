"""One module per operator family; everything is DataFrame in, DataFrame out."""
