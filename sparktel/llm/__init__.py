"""Training-data operators. Nothing outside this subpackage imports it; every module here can be deleted as a whole."""
