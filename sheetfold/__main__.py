from sheetfold.cli import main

main()
