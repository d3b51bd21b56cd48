"""Reading documents and keeping collections of them."""
